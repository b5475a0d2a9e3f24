"""Models behind an HTTP interface, as the callables that the classifier asks."""

from __future__ import annotations

import json
import os
import urllib.request
from dataclasses import dataclass, field
from typing import Any

from tamiz.sources.pages import FetchPolicy, fetch

PROMPT = "{prompt}"


def _filled(body: Any, prompt: str) -> Any:
    """``body`` with the prompt in the place of each :data:`PROMPT`."""
    if isinstance(body, dict):
        return {k: _filled(v, prompt) for k, v in body.items()}
    if isinstance(body, list):
        return [_filled(v, prompt) for v in body]
    return body.replace(PROMPT, prompt) if isinstance(body, str) else body


@dataclass(frozen=True)
class HttpModel:
    """A model that takes a prompt in a JSON body and answers in JSON.

    ``path`` leads to the answer's text in what comes back, by keys and numbers. The value of ``key_variable`` of the task's
    environment, if that is named, goes into the header ``key_header``. Failures are retried as ``policy`` says; the last one
    is raised, which the classifier takes for an empty answer.
    """

    url: str
    body: Any = field(default_factory=lambda: {"prompt": PROMPT})
    path: tuple[str | int, ...] = ("text",)
    key_variable: str | None = None
    key_header: str = "Authorization"
    policy: FetchPolicy = FetchPolicy(timeout=60.0)

    def __call__(self, prompt: str) -> str:
        sent = json.dumps(_filled(self.body, prompt)).encode()

        def post(url: str, headers: dict[str, str], proxy: str | None, timeout: float) -> tuple[int, str]:
            own = {"Content-Type": "application/json"} | ({self.key_header: os.environ[self.key_variable]} if self.key_variable else {})
            with urllib.request.urlopen(urllib.request.Request(url, data=sent, headers=own, method="POST"), timeout=timeout) as r:
                return r.status, r.read().decode()

        page = fetch(self.url, self.policy, post)
        if page["html"] is None:
            raise OSError(page["error"])
        at: Any = json.loads(page["html"])
        for k in self.path:
            at = at[k]
        return str(at)
