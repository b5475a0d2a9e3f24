"""Deduplication of new batches against everything accepted before.

An index of accepted records is kept on disk, partitioned by hash: a row holds a record's minwise band keys as its signature,
and its title once. A new batch is brought to canonical forms and equal forms are merged; its band keys meet the index only
in the buckets that its own keys fall into, and the index is streamed past them without being moved. What shares a key is
verified word by word. What the index does not hold is resolved inside the batch in order of arrival, and the records
accepted are appended. Buckets are split as the index grows, so that what a batch reads grows with the batch.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from difflib import SequenceMatcher

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tamiz.llm.batch_forms import address, figures, numbered, title_tokens
from tamiz.llm.encoding import PairModel, repair
from tamiz.session import spread, staged, work_path

#: Band keys of a record, each the least hash of its character triples under its own seed. Two titles that share half of
#: their triples agree in at least one of twelve but for one case in four thousand.
BANDS = 12
#: Letters of a title up to which all titles of one identity share a key besides: they have too few triples to rely on.
SHORT = 20
#: Records of a bucket of the index, on the mean, beyond which all buckets are split; least buckets.
BUCKET_RECORDS, LEAST_BUCKETS = 65_536, 16
#: Most forms of a batch whose band keys are broadcast to the index (some 100 MB); those of larger ones are shuffled with it.
BROADCAST_FORMS = 200_000
#: Forms that a task resolves, on the mean, in a large batch.
FORMS_PER_TASK = 20_000
#: Most buckets that are named to the scan one by one.
NAMED_BUCKETS = 4_096
#: Different forms of one identity that pass through one task; larger groups are settled in rounds by all tasks.
HOT_FORMS = 10_000

_SEEDS = np.array([0x9E3779B97F4A7C15 * (k + 1) & 0xFFFFFFFFFFFFFFFF for k in range(BANDS)], dtype=np.uint64)
_SHIFT, _FACTOR = np.uint64(33), np.uint64(0xFF51AFD7ED558CCD)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _SHIFT)) * _FACTOR
    return h ^ (h >> _SHIFT)


def minwise(title: str) -> np.ndarray:
    """The least hash of the title's character triples under each seed; a shorter title is one triple."""
    t = np.frombuffer(title.replace(".", "").replace(" ", "").ljust(3).encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    triples = (t[:-2] << np.uint64(42)) ^ (t[1:-1] << np.uint64(21)) ^ t[2:]  # a character has at most 21 bits
    return _mixed(_mixed(triples * _FACTOR)[:, None] ^ _SEEDS).min(axis=0)


def band_keys(identity: str, title: str) -> list[int]:
    """Band keys of a record: a key names the identity, the band and the least hash of the title's character triples; a short
    title has one more, which names the identity."""
    own = np.uint64(xxhash.xxh64_intdigest(identity))
    keys = _mixed((minwise(title) ^ own) * _FACTOR + _SEEDS).view(np.int64).tolist()
    return [*keys, int(own.view(np.int64))] if len(title.replace(".", "").replace(" ", "")) <= SHORT else keys


def edits(a: str, b: str, most: int) -> int:
    """Insertions, deletions, changes and swaps of neighbours from ``a`` to ``b``; ``most + 1`` if there are more.

    A lost letter (``?`` or the replacement character) stands for any letter.
    """
    if abs(len(a) - len(b)) > most:
        return most + 1
    before, row = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, before, row = before, row, [i]
        for j, y in enumerate(b, 1):
            same = x == y or x in "?�" or y in "?�"
            cost = min(before[j] + 1, row[j - 1] + 1, before[j - 1] + (not same))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                cost = min(cost, last[j - 2] + 1)
            row.append(cost)
        if min(row) > most:
            return most + 1
    return row[-1]


def _abbreviates(short: str, word: str) -> bool:
    """True if ``short`` (with its point) abbreviates ``word``: same first letter, letters in order."""
    if not short.endswith(".") or len(short) > 7 or len(short) > len(word) or not short[:-1] or short[0] != word[0]:
        return False
    rest = iter(word)
    return all(c in rest for c in short[:-1])


def same_title(a: list[str], b: list[str]) -> bool:
    """True if two titles with equal figures say the same, allowing for abbreviations, misspelled and damaged words.

    A word may differ by one edit, a longer one (seven letters on) by two or, from ten on, three; a group of words that was
    split or joined counts as one word. At most a third of the words may differ.
    """
    if a == b:
        return True
    differing = 0
    for op, i1, i2, j1, j2 in SequenceMatcher(None, a, b, autojunk=False).get_opcodes():
        if op == "equal":
            continue
        x, y = a[i1:i2], b[j1:j2]
        pairs = list(zip(x, y, strict=True)) if len(x) == len(y) else [("".join(x), "".join(y))]
        for p, q in pairs:
            if p.rstrip(".") == q.rstrip("."):
                continue
            if _abbreviates(p, q) or _abbreviates(q, p):
                differing += 1
                continue
            p, q = p.replace(".", ""), q.replace(".", "")
            size = max(len(p), len(q))
            allowed = 0 if min(len(p), len(q)) < 2 else 1 if size < 7 else 2 if size < 10 else 3
            if edits(p, q, allowed) > allowed:
                return False
            differing += 1
    return 3 * differing <= max(len(a), len(b), 3)


def canonical_rows(rows: DataFrame, model: PairModel | None = None) -> DataFrame:
    """``raw_id, identity, title`` of records with a bill number: what the record is, and its title's canonical words.

    ``rows`` has ``raw_id, no_camara, no_senado, proyecto, detail_url``; others are ignored. ``identity`` joins bill number
    and year, Senate number, page and the figures of the title; NULL and blank fields are empty there. Rows whose bill
    number is NULL or blank are left out. ``raw_id`` is unique. ``model`` restores garbled titles first.
    """

    def canon(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cost: dict[tuple[str, str], float] = {}
        known: dict[str | None, tuple[str, str]] = {}
        for b in batches:
            keep, identities, titles = [], [], []
            columns = [b.column(i).to_pylist() for i in range(5)]
            for i, (_, bill, senate, title, url) in enumerate(zip(*columns, strict=True)):
                number = numbered(bill)
                if not number:
                    continue
                if (got := known.get(title)) is None:
                    if len(known) > 50_000:
                        known.clear()
                    clean = repair(title, model, cost)[0] if title and model else title
                    tokens = title_tokens(clean)
                    got = known[title] = (" ".join(tokens), figures(tokens))
                keep.append(i)
                identities.append(f"{number}|{numbered(senate)}|{address(url)}|{got[1]}")
                titles.append(got[0])
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(keep, pa.int64())), pa.array(identities, pa.string()), pa.array(titles, pa.string())], names=["raw_id", "identity", "title"]
            )

    picked = rows.select(F.col("raw_id").cast("bigint").alias("raw_id"), *[F.col(c).cast("string").alias(c) for c in ("no_camara", "no_senado", "proyecto", "detail_url")])
    return spread(picked).mapInArrow(canon, "raw_id bigint, identity string, title string")


_FORM = "first bigint, identity string, title string, place bigint, signature array<bigint>"
_RESOLVED = f"{_FORM}, leader bigint"


def signed_forms(canonical: DataFrame) -> DataFrame:
    """Distinct forms of :func:`canonical_rows`, which have been :func:`~tamiz.session.staged`: ``first`` row, ``identity``, ``title``, ``place`` (hash of the identity) and
    ``signature`` (band keys)."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = [band_keys(i, t) for i, t in zip(b.column("identity").to_pylist(), b.column("title").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(keys, pa.list_(pa.int64()))], names=["first", "identity", "title", "place", "signature"])

    forms = canonical.groupBy("identity", "title").agg(F.min("raw_id").alias("first"))
    # Few bytes, but much work for each: spread over all cores, whatever the bytes say.
    tasks = max(canonical.sparkSession.sparkContext.defaultParallelism, canonical.count() // FORMS_PER_TASK)
    forms = forms.repartition(tasks, "identity")
    return forms.select("first", "identity", "title", F.xxhash64("identity").alias("place")).mapInArrow(sign, _FORM)


def _bucket(buckets: int) -> F.Column:
    return F.pmod("place", F.lit(buckets)).cast("int")


class BatchIndex:
    """The persistent index of accepted records, and the check of batches against it.

    Below ``path``: a state file for each step, made only if no other writer made it, and folders of resolved forms,
    partitioned by ``kind`` (accepted or repeat) and bucket. Folders that no state names are left-overs of failed steps.
    """

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark = spark
        self.path = (path or work_path(spark, "batch-index")).rstrip("/")
        #: Buckets, folders of the index, accepted records, and number of the last step.
        self.state: dict = {"step": -1, "buckets": LEAST_BUCKETS, "folders": [], "records": 0}
        fs, at = self._fs()
        if fs.exists(at(self.path)):
            names = [x.getPath().getName() for x in fs.listStatus(at(self.path)) if x.getPath().getName().startswith("_state-")]
            if names:
                stream = fs.open(at(f"{self.path}/{max(names)}"))
                self.state = json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
                stream.close()

    def _fs(self):
        at = self.spark._jvm.org.apache.hadoop.fs.Path
        return at(self.path).getFileSystem(self.spark._jsc.hadoopConfiguration()), at

    def _commit(self, **changes) -> None:
        self.state = self.state | changes | {"step": self.state["step"] + 1}
        fs, at = self._fs()
        out = fs.create(at(f"{self.path}/_state-{self.state['step']:012d}"), False)
        out.write(bytearray(json.dumps(self.state).encode()))
        out.close()

    def read(self, buckets: list[int] | None = None) -> DataFrame:
        """Accepted records, of all or the given buckets."""
        rows = self._parts(self.state["folders"]).where("kind = 'accepted'")
        return rows if buckets is None else rows.where(F.col("bucket").isin(buckets))

    def candidates(self, forms: DataFrame, size: int, touched: list[int] | None) -> DataFrame | None:
        """``first, accepted, theirs``: forms with the accepted records that share a band key, each pair once; only the
        buckets ``touched`` are read, if they are given."""
        if not self.state["folders"]:
            return None
        small = F.broadcast if size <= BROADCAST_FORMS else lambda df: df
        held = self.read(touched).select("place", F.col("first").alias("accepted"), F.col("title").alias("theirs"), F.col("signature").alias("keys"))
        # Records of other identities are dropped before the keys are laid out.
        held = held.join(small(forms.select("place").distinct()), "place", "left_semi").select("accepted", "theirs", F.explode("keys").alias("band"))
        met = held.join(small(forms.select("first", F.explode("signature").alias("band"))), "band")
        # A pair that shares several keys comes out of one task, and leaves it once.
        return met.groupBy("first", "accepted").agg(F.first("theirs").alias("theirs"))

    def check(self, forms: DataFrame) -> str:
        """Checks a batch of :func:`signed_forms`, appends what is new to the index, and gives the folder of the result.

        That holds the forms with ``leader``, the accepted row that says the same, the first such; their own ``first`` where
        they are accepted. An empty batch changes nothing but the number of the step.
        """
        # One look at the batch: how many forms, how many of one identity at most, and the buckets they fall into.
        places = forms.groupBy("place").agg(F.count(F.lit(1)).alias("n"))
        fallen = places.groupBy(_bucket(self.state["buckets"]).alias("b")).agg(F.sum("n").alias("n"), F.max("n").alias("most")).limit(NAMED_BUCKETS + 1).collect()
        known = len(fallen) <= NAMED_BUCKETS
        size = sum(r["n"] for r in fallen) if known else forms.count()
        found = self.candidates(forms, size, [r["b"] for r in fallen] if known else None)
        hot = None
        if not known or any(r["most"] > HOT_FORMS for r in fallen):
            hot = staged(places.where(F.col("n") > HOT_FORMS).select("place"), "hot-places")
            hot = None if hot.isEmpty() else hot
        usual = forms if hot is None else forms.join(hot, "place", "left_anti").select(forms.columns)
        tasks = max(self.spark.sparkContext.defaultParallelism, size // FORMS_PER_TASK)
        resolved = resolve_in_order(usual, found, self.state["buckets"], min(tasks, self.state["buckets"]))
        if hot is not None:
            resolved = resolved.unionByName(settle_in_rounds(forms.join(hot, "place", "left_semi").select(forms.columns), found))
        folder = f"part=step-{self.state['step'] + 1}-{uuid.uuid4().hex[:8]}"
        kind = F.when(F.col("leader") == F.col("first"), "accepted").otherwise("repeat")
        laid = resolved.withColumn("kind", kind).withColumn("bucket", F.when(kind == "accepted", _bucket(self.state["buckets"])).otherwise(0))
        seen = Observation()
        laid = laid.observe(seen, F.count(F.when(F.col("leader") == F.col("first"), 1)).alias("fresh"))
        laid.write.partitionBy("kind", "bucket").parquet(f"{self.path}/{folder}")
        fresh = seen.get["fresh"]
        self._commit(folders=[*self.state["folders"], *[folder] * bool(fresh)], records=self.state["records"] + fresh)
        if self.state["records"] > 2 * BUCKET_RECORDS * self.state["buckets"]:
            self._split()
        return folder

    def _split(self) -> None:
        """Writes the index anew in enough buckets, in one folder; the work is that of the appends since the last time."""
        count = LEAST_BUCKETS
        while count * BUCKET_RECORDS < 2 * self.state["records"]:
            count *= 2
        folder = f"part=split-{self.state['step'] + 1}-{uuid.uuid4().hex[:8]}"
        laid = self.read().drop("part").withColumn("bucket", _bucket(count))
        laid.repartition(min(count, 4096), "bucket").write.partitionBy("kind", "bucket").parquet(f"{self.path}/{folder}")
        self._commit(folders=[folder], buckets=count)

    def _parts(self, folders: list[str]) -> DataFrame:
        schema = f"{_RESOLVED}, part string, kind string, bucket int"
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", self.path).parquet(*[f"{self.path}/{f}" for f in folders])

    def accept(self, rows: DataFrame) -> DataFrame:
        """:meth:`check` of a batch of :func:`canonical_rows`, as ``raw_id, leader`` of each of its rows."""
        rows = staged(rows, "batch-canonical")
        return self.leaders(rows, [self.check(staged(signed_forms(rows), "batch-forms"))])

    def leaders(self, rows: DataFrame, folders: list[str]) -> DataFrame:
        """``raw_id, leader`` of rows whose forms were resolved into ``folders``."""
        return rows.join(self._parts(folders).select("identity", "title", "leader"), ["identity", "title"]).select("raw_id", "leader")


def resolve_in_order(forms: DataFrame, found: DataFrame | None, buckets: int, tasks: int) -> DataFrame:
    """``forms`` with their ``leader``, in order of arrival.

    ``found``: accepted records that a form may repeat (see :meth:`BatchIndex.candidates`). Forms of one identity pass through
    one task as a sorted stream, each followed by its candidates; only those accepted are remembered, by band key, and a form
    is compared with those that share a key with it.
    """
    names = ["first", "identity", "title", "place", "signature", "leader"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current: str | None = None
        near: dict[int, list[int]] = {}
        remembered: dict[int, list[str]] = {}
        out: list[tuple] = []
        form: tuple | None = None
        leader: int | None = None

        def settle() -> None:
            nonlocal current, near, remembered
            first, identity, title, _, signature = form
            if leader is not None:
                out.append((*form, leader))
                return
            if identity != current:
                current, near, remembered = identity, {}, {}
            tokens = title.split()
            own = next((a for a in sorted({a for k in signature for a in near.get(k, ())}) if same_title(tokens, remembered[a])), first)
            if own == first:
                remembered[first] = tokens
                for k in set(signature):
                    near.setdefault(k, []).append(first)
            out.append((*form, own))

        for b in batches:
            for *one, accepted, theirs in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if form is None or one[0] != form[0]:
                    if form is not None:
                        settle()
                    form, leader = tuple(one), None
                if accepted is not None and leader is None and (theirs == form[2] or same_title(form[2].split(), theirs.split())):
                    leader = accepted
            if len(out) >= 4096:
                yield _resolved_batch(out, names)
                out = []
        if form is not None:
            settle()
        yield _resolved_batch(out, names)

    rows = forms.select(*names[:5], F.lit(None).cast("bigint").alias("accepted"), F.lit(None).cast("string").alias("theirs"))
    if found is not None:
        rows = rows.unionByName(forms.select(*names[:5]).join(found, "first").select(*names[:5], "accepted", "theirs"))
    ordered = rows.repartition(tasks, _bucket(buckets)).sortWithinPartitions("place", "identity", "first", F.asc_nulls_first("accepted"))
    return ordered.mapInArrow(run, _RESOLVED)


def _resolved_batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.list_(pa.int64()), pa.int64()]
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def _verified(pairs: DataFrame) -> DataFrame:
    """``first, leader``: of ``first, title, accepted, theirs`` the least accepted record that says the same as the form."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            good = [i for i, (x, y) in enumerate(zip(b.column("title").to_pylist(), b.column("theirs").to_pylist(), strict=True)) if x == y or same_title(x.split(), y.split())]
            kept = b.take(pa.array(good, pa.int64()))
            yield pa.RecordBatch.from_arrays([kept.column("first"), kept.column("accepted")], names=["first", "accepted"])

    return pairs.select("first", "title", "accepted", "theirs").mapInArrow(verify, "first bigint, accepted bigint").groupBy("first").agg(F.min("accepted").alias("leader"))


def settle_in_rounds(forms: DataFrame, found: DataFrame | None) -> DataFrame:
    """The same as :func:`resolve_in_order` by all tasks together, for identities with very many different forms.

    In each round those open forms are accepted that are the first open ones under all their band keys, since nothing before
    them can be like them; every later form is then compared with the one record newly accepted under each of its keys.
    """
    state = forms.withColumn("leader", F.lit(None).cast("bigint")).withColumn("past", F.lit(False))
    if found is not None:
        old = _verified(forms.join(found, "first"))
        state = forms.join(old, "first", "left").withColumn("past", F.col("leader").isNotNull())
    state = staged(state, "hot-forms")
    while not state.where("leader IS NULL").isEmpty():
        laid = state.where("leader IS NULL").select("first", F.explode(F.array_distinct("signature")).alias("band"))
        least = laid.groupBy("band").agg(F.min("first").alias("least"))
        fresh = laid.join(least, "band").groupBy("first").agg(F.bool_and(F.col("least") == F.col("first")).alias("free")).where("free").select("first")
        fresh = staged(fresh.join(state.select("first", "title", "signature"), "first"), "hot-accepted")
        keys = fresh.select(F.col("first").alias("accepted"), F.col("title").alias("theirs"), F.col("signature").alias("keys"), F.explode(F.array_distinct("signature")).alias("band"))
        # What the index holds came before all of the batch; other repeats may still find an earlier record.
        mine = state.where("NOT past AND (leader IS NULL OR leader <> first)").select("first", "title", "signature", F.explode(F.array_distinct("signature")).alias("band"))
        pairs = mine.join(keys, "band").where((F.col("first") > F.col("accepted")) & (F.element_at(F.array_intersect("signature", "keys"), 1) == F.col("band")))
        said = _verified(pairs).withColumnRenamed("leader", "now")
        own = fresh.select("first", F.lit(True).alias("fresh"))
        leader = F.when(F.col("fresh"), F.col("first")).otherwise(F.least("leader", "now"))
        state = staged(state.join(said, "first", "left").join(own, "first", "left").select(*forms.columns, leader.alias("leader"), "past"), "hot-forms")
    return state.drop("past")


def arrival_steps(rows: DataFrame, load: str, order: str, held: int = 0) -> list[tuple[int, int]]:
    """Ranges of ``order`` that are checked one after the other: a new one begins where a load first appears.

    Rows of a load that come late belong to the range in which they arrive. Loads that wait are taken together as long as
    they are no more than what was taken before them (``held`` records at first), so that k of them need some log k steps.
    """
    spans = sorted((r["lo"], r["n"]) for r in rows.groupBy(F.col(load).alias("l")).agg(F.min(order).alias("lo"), F.count(F.lit(1)).alias("n")).collect())
    if not spans:
        return []
    starts: list[int] = []
    before, own = held, 0
    for lo, n in spans:
        if not starts or own + n > before:
            before, own = before + own, 0
            starts.append(lo)
        own += n
    return [(a, b - 1) for a, b in zip(starts, [*starts[1:], 1 << 63], strict=True)]


def deduplicate_batches(rows: DataFrame, load: str, model: PairModel | None = None, path: str | None = None) -> DataFrame:
    """``raw_id, leader`` of all rows of all batches, checked step by step in order of arrival against one growing index."""
    canonical = staged(canonical_rows(rows, model), "batch-canonical")
    forms = staged(signed_forms(canonical), "batch-forms")
    index = BatchIndex(rows.sparkSession, path)
    folders = [index.check(forms.where(F.col("first").between(lo, hi))) for lo, hi in arrival_steps(rows, load, "raw_id", index.state["records"])]
    return index.leaders(canonical, folders)
