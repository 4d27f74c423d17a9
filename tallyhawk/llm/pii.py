"""Personal data: patterns propose spans, checksums confirm them, context
words move the score.  DataFrame functions only.

Positions come from the text itself: splitting it at a pattern gives the gaps
between its matches, and running sums of gap and match lengths (code points)
give start and end.  Every pattern is written so that it starts only at the
beginning of a run (or where the previous match ended) and never backtracks
into one, so its time is linear in the text and long runs can't exhaust the
matcher's stack.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhawk.llm.common import table

_LOCAL = "A-Za-z0-9._%+-"
#: kind -> (cheap test that any match must pass, pattern), in output order.
PATTERNS = {
    "email": ("@", rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    "ip": (r"[0-9]\.[0-9]", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"),
    "card": (r"[0-9][\x20-]?[0-9]", r"[0-9](?:[\x20-]?[0-9])++"),
    "phone": (r"\+[0-9]", r"\+[0-9][\x20().0-9-]+[0-9]"),
    "iban": (
        r"[A-Z]{2}[0-9]{2}",
        r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?)(?![A-Za-z0-9])",
    ),
    "ssn": (r"[0-9]{3}-[0-9]", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
}
BASE = ("email", "ip", "card", "phone")
#: kind -> (score of a confirmed span, words that raise it when they occur
#: within CONTEXT code points on either side).
SCORES = {
    "email": (0.9, "mail|contact|@"),
    "ip": (0.6, "ip|addr|host|server"),
    "card": (0.8, "card|visa|master|credit|debit|payment|kart|carte|tarjeta"),
    "phone": (0.6, "phone|tel|call|mobile|fax"),
    "iban": (0.9, "iban|bank|account|konto|cuenta|compte"),
    "ssn": (0.3, "ssn|social|security|tax"),
}
CONTEXT, RAISE, REPORT = 40, 0.3, 0.5
_CHUNK = 256


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Sum of the digits, every second one from the right doubled (less 9 if
    above 9), divisible by 10."""
    n = F.length(digits)
    one = lambda i: F.substring(digits, i, F.lit(1)).cast("int")
    total = F.aggregate(
        F.sequence(F.lit(1), n),
        F.lit(0),
        lambda a, i: a
        + F.when((n - i) % 2 == 0, one(i)).otherwise(one(i) * 2 - F.when(one(i) > 4, 9).otherwise(0)),
    )
    return total % 10 == 0


def _mod97(iban: Column) -> Column:
    """The account check number: country and check digits moved to the end,
    letters read as 10..35, the number modulo 97 must be 1."""
    moved = F.concat(F.substring(iban, F.lit(5), F.length(iban)), F.substring(iban, 1, 4))
    code = lambda ch: F.ascii(ch) - F.when(F.ascii(ch) >= 65, 55).otherwise(48)
    rest = F.aggregate(
        F.split(moved, ""),
        F.lit(0),
        lambda a, ch: F.when(ch == "", a).otherwise((a * F.when(code(ch) >= 10, 100).otherwise(10) + code(ch)) % 97),
    )
    return rest == 1


def _valid(kind: str, m: Column) -> Column:
    if kind == "ip":
        parts = F.transform(F.split(m, r"\."), lambda p: F.ltrim(p, F.lit("0")))
        return F.forall(parts, lambda p: (F.length(p) < 3) | ((F.length(p) == 3) & (p <= "255")))
    if kind == "card":
        d = _digits(m)
        return F.when(F.length(d).between(13, 19), _luhn(d)).otherwise(False)
    if kind == "phone":
        return F.length(_digits(m)).between(9, 15)
    if kind == "iban":
        d = F.replace(m, F.lit(" "), F.lit(""))
        return F.length(d).between(15, 34) & _mod97(d)
    if kind == "ssn":
        return ~m.rlike("^(?:000|666|9)|-00-|-0000$")
    return F.lit(True)


def _keeps(kind: str):
    return lambda x: _valid(kind, x["m"])


def _scored(kind: str):
    start, words = SCORES[kind]

    def one(x):
        near = F.concat(
            F.substring(F.col("t"), F.greatest(x["s"] - CONTEXT + 1, F.lit(1)), F.least(x["s"], F.lit(CONTEXT))),
            F.lit(" "),
            F.substring(F.col("t"), x["e"] + 1, F.lit(CONTEXT)),
        )
        raised = F.when(F.lower(near).rlike(words), RAISE).otherwise(0.0)
        return F.struct(
            x["s"].alias("start"), x["e"].alias("end"), F.least(F.lit(1.0), F.lit(start) + raised).alias("score")
        )

    return one


def _located(text: Column, pattern: str) -> Column:
    """array<struct<s, e, m>> of all matches.  Positions are added up in
    chunks, so that a text with very many matches copies no long array."""
    found = F.regexp_extract_all(text, F.lit(pattern), 0)
    both = F.struct(F.split(text, pattern, -1).alias("g"), found.alias("m"))
    empty = F.array().cast("array<struct<s:int,e:int,m:string>>")

    def one(v):
        def chunk(acc, c):
            inner = F.aggregate(
                F.sequence(c, F.least(c + (_CHUNK - 1), F.size(v["m"]) - 1)),
                F.struct(acc["pos"].alias("pos"), empty.alias("out")),
                lambda a, i: F.struct(
                    (a["pos"] + F.length(v["g"][i]) + F.length(v["m"][i])).alias("pos"),
                    F.concat(
                        a["out"],
                        F.array(
                            F.struct(
                                (a["pos"] + F.length(v["g"][i])).alias("s"),
                                (a["pos"] + F.length(v["g"][i]) + F.length(v["m"][i])).alias("e"),
                                v["m"][i].alias("m"),
                            )
                        ),
                    ).alias("out"),
                ),
            )
            return F.transform(F.array(inner), lambda r: F.struct(
                r["pos"].alias("pos"), F.concat(acc["out"], F.array(r["out"])).alias("out")))[0]

        return F.aggregate(
            F.sequence(F.lit(0), F.size(v["m"]) - 1, F.lit(_CHUNK)),
            F.struct(F.lit(0).alias("pos"), F.array().cast("array<array<struct<s:int,e:int,m:string>>>").alias("out")),
            chunk,
            lambda a: F.flatten(a["out"]),
        )

    return F.transform(F.array(both), lambda v: F.when(F.size(v["m"]) == 0, empty).otherwise(one(v)))[0]


def find_pii(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, the spans of every kind as
    array<struct<start, end, score>> (columns of the kinds' names).

    Spans of the base kinds all stay; of the added kinds (iban: mod 97, ssn:
    number ranges) those whose score, raised by context words, reaches
    REPORT.  A null text counts as empty and has no spans; ids may be null or
    repeated (a row is never joined to another); other columns are ignored.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    out = df.select(F.col(id_col).alias("doc_id"), text.alias("t"))
    empty = F.array().cast("array<struct<s:int,e:int,m:string>>")
    cols = []
    for kind, (cheap, pattern) in PATTERNS.items():
        test = F.contains("t", F.lit("@")) if cheap == "@" else F.col("t").rlike(cheap)
        located = F.when(test, _located(F.col("t"), pattern)).otherwise(empty)
        cols.append(F.filter(located, _keeps(kind)).alias(f"raw_{kind}"))
    out = out.select("doc_id", "t", *cols)
    scored = []
    for kind in PATTERNS:
        spans = F.transform(f"raw_{kind}", _scored(kind))
        scored.append((spans if kind in BASE else F.filter(spans, lambda x: x["score"] >= REPORT)).alias(kind))
    return out.select("doc_id", *scored)


def digest(found: DataFrame) -> DataFrame:
    """Counts, the hash of the base spans and all spans as text."""

    def named(kind):
        return F.transform(kind, lambda x: F.concat_ws(":", F.lit(kind), x["start"], x["end"]))

    def joined(kinds):
        return F.concat_ws(",", *map(named, kinds))

    return found.select(
        "doc_id",
        *[F.size(k).cast("long").alias(f"n_{k}") for k in BASE],
        F.sha2(joined(BASE), 256).alias("base_sha256"),
        joined(PATTERNS).alias("spans"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(find_pii(table(spark, sf_dir, "documents")))


def _sql_kind(kind: str, pattern: str, valid: str) -> str:
    """Spans of one kind as a list of texts 'kind:start:end'."""
    return f"""list_transform(list_filter(list_transform(range(1, len(m_{kind}) + 1), lambda i: {{
      's': coalesce(list_sum(list_transform(g_{kind}[1:i], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(m_{kind}[1:i-1], lambda x: length(x))), 0),
      'm': m_{kind}[i]}}), lambda x: {valid}), lambda x: '{kind}:' || (x.s)::BIGINT || ':' || (x.s + length(x.m))::BIGINT)"""


_SQL_PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"\b[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?)\b",
    "ssn": r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b",
}
_DIG = "regexp_replace(x.m, '[^0-9]', '', 'g')"
_IBAN = "replace(x.m, ' ', '')"
_SQL_VALID = {
    "email": "true",
    "ip": r"len(list_filter(string_split(x.m, '.'), lambda p: length(ltrim(p, '0')) > 3 OR (length(ltrim(p, '0')) = 3 AND ltrim(p, '0') > '255'))) = 0",
    "card": f"length({_DIG}) BETWEEN 13 AND 19 AND list_sum(list_transform(range(1, 20), lambda j: CASE WHEN j > length({_DIG}) THEN 0 WHEN j % 2 = 1 THEN substr(reverse({_DIG}), j, 1)::INT ELSE substr(reverse({_DIG}), j, 1)::INT * 2 - CASE WHEN substr(reverse({_DIG}), j, 1)::INT > 4 THEN 9 ELSE 0 END END)) % 10 = 0",
    "phone": f"length({_DIG}) BETWEEN 9 AND 15",
    "iban": f"length({_IBAN}) BETWEEN 15 AND 34 AND list_reduce(list_prepend(0, list_transform(string_split(substr({_IBAN}, 5) || substr({_IBAN}, 1, 4), ''), lambda ch: ascii(ch) - CASE WHEN ascii(ch) >= 65 THEN 55 ELSE 48 END)), lambda a, d: (a * CASE WHEN d >= 10 THEN 100 ELSE 10 END + d) % 97) = 1",
    "ssn": r"NOT regexp_matches(x.m, '^(?:000|666|9)|-00-|-0000$') AND regexp_matches(lower(substr(t, greatest(x.s - 39, 1)::BIGINT, least(x.s, 40)::BIGINT) || ' ' || substr(t, (x.s + length(x.m) + 1)::BIGINT, 40)), 'ssn|social|security|tax')",
}
ORACLE_SQL = (
    "WITH d AS (SELECT doc_id, coalesce(text, '') AS t, "
    + ", ".join(
        f"regexp_extract_all(t, '{p}') AS m_{k}, string_split_regex(t, '{p}') AS g_{k}" for k, p in _SQL_PATTERNS.items()
    )
    + " FROM documents), s AS (SELECT doc_id, "
    + ", ".join(f"{_sql_kind(k, p, _SQL_VALID[k])} AS {k}" for k, p in _SQL_PATTERNS.items())
    + " FROM d) SELECT doc_id, "
    + ", ".join(f"len({k})::BIGINT AS n_{k}" for k in BASE)
    + ", sha256(array_to_string(list_concat(list_concat(email, ip), list_concat(card, phone)), ',')) AS base_sha256"
    + ", array_to_string(list_concat(list_concat(list_concat(email, ip), list_concat(card, phone)), list_concat(iban, ssn)), ',') AS spans FROM s"
)
