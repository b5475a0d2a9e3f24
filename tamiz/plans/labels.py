"""Rules and labels of the shipped classification: fixed values."""

CATEGORIES = [
    "minero-energético", "servicios", "tecnología", "agricultura", "manufactura", "transporte", "salud",
    "educación", "telecomunicaciones", "construcción", "turismo", "financiero", "alimentos", "otros",
]

#: In order; the first that is found counts.
RULES = [
    ("miner[ií]a|oro|gas|petr[oó]leo", "minero-energético"),
    ("software|tecnolog", "tecnología"),
    ("caf[eé]|agricultura", "agricultura"),
    ("servicio", "servicios"),
    ("transport", "transporte"),
    ("salud", "salud"),
    ("educaci[oó]n|educ", "educación"),
    ("financ", "financiero"),
    ("aliment", "alimentos"),
    ("CREACI[ÓO]N.*DISTRITO|DISTRITO", "construcción"),
    ("(?i)tratado.*transpacífico|tratado", "financiero"),
    ("(?i)carretera|infraestructura", "transporte"),
]
