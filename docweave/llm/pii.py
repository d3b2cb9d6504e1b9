"""Personal data: regular expressions propose spans, checksums confirm them,
nearby words adjust the score.

Everything is SQL functions over one row per document: no shuffle, no Python.
A pattern is run twice over a text that has a match, once for the matches and
once (``split``) for what lies between them; running sums of the lengths give
the positions, in blocks so that texts with very many matches stay linear.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.llm import common

#: Base kinds, in the order in which spans are listed, then the added kinds.
BASE_KINDS = ["email", "ip", "card", "phone"]
ADDED_KINDS = ["iban", "ssn"]
KINDS = BASE_KINDS + ADDED_KINDS

#: The patterns.  Each is written so that a run of characters is scanned once:
#: a match begins where its run begins (or where the last match ended), and what
#: can't be given back is possessive.  They match just what the plain forms in
#: the comments match.
PATTERNS = {
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # [0-9]([\x20-]?[0-9])+
    "card": r"[0-9](?:[ -]?[0-9])++",
    # \+[0-9][\x20().0-9-]+[0-9]
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    # two letters, two check digits, 11 to 30 more, in groups or not: the first group is the
    # longest such run, which words in capitals may lengthen; only the letters are consumed,
    # so that each beginning is proposed
    "iban": r"(?<![A-Za-z0-9])(?=([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])))[A-Z]{2}",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}

#: A text without one of these has no match of the kind.
NEEDS = {"email": "@", "ip": ".", "phone": "+", "ssn": "-"}

#: Score of a confirmed span without context, and the words that raise it when
#: they occur within CONTEXT_CHARS before or after the span.
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.9, "ssn": 0.4}
CONTEXT = {
    "email": "e-?mail|contact|write to|mailto",
    "ip": r"\bip\b|address|server|host|client|login",
    "card": "card|credit|visa|mastercard|amex|payment|billing",
    "phone": r"phone|call|tel\b|mobile|fax|whatsapp",
    "iban": "iban|bank|account|konto|compte|cuenta|transfer",
    "ssn": r"ssn|social security|\btax\b|insurance number",
}
CONTEXT_CHARS = 40
CONTEXT_BONUS = 0.3
#: Words that say it is an example or a version, not a person's.
DENIAL = {"ip": "version|release|netmask", "ssn": "example|order|part no|isbn"}
DENIAL_MALUS = 0.3
#: Added kinds need this score; base kinds stay whatever their score.
THRESHOLD = 0.5

#: Lengths of registered IBANs, which decide where several beginnings of a run are valid.
IBAN_LENGTHS = (
    "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DK18 DO28 EE20 EG29 ES24 FI18 FO18 FR27 GB22 GE22 GI23 GL18 "
    "GR27 GT28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21 MC27 MD24 ME22 MK19 MR27 MT31 MU30 NL18 NO15 PK24 "
    "PL28 PS29 PT25 QA29 RO24 RS22 SA24 SC31 SE24 SI19 SK24 SM27 TN24 TR26 UA29 VA22 VG24 XK20")

#: Matches per block of the running sums.
BLOCK = 256

_DIGITS = "regexp_replace({m}, '[^0-9]', '')"
#: Confirms a match ``{m}``.
_VALID = {
    "email": "true",
    "ip": r"regexp_like({m}, r'^(?:0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9]|)(?:\.|\z)){{4}}\z')",
    "card": f"length({_DIGITS}) BETWEEN 16 AND 19 AND luhn_check({_DIGITS})",
    "phone": f"length({_DIGITS}) BETWEEN 8 AND 15",
    "ssn": r"NOT regexp_like({m}, r'^(?:000|666|9)|-00-|-0000\z')",
    # Check digits to the end, letters as 10 to 35, then mod 97, seven digits at a time.
    "iban": "length(replace({m}, ' ', '')) BETWEEN 15 AND 34 AND aggregate(regexp_extract_all("
            "array_join(transform(regexp_extract_all(concat(substring(replace({m}, ' ', ''), 5), substring({m}, 1, 4)), '.', 0),"
            " c -> IF(c >= 'A', cast(ascii(c) - 55 AS string), c)), ''), '.{{1,7}}', 0),"
            " 0L, (r, d) -> cast(concat(r, d) AS bigint) % 97) = 1",
}


def _starts(gaps: str, matches: str) -> str:
    """SQL: the match positions, from the lengths of what lies before each
    match (``gaps``, one more than matches) and of the matches."""
    both = f"zip_with(slice({gaps}, 1, size({matches})), {matches}, (g, m) -> named_struct('g', length(g), 'm', length(m)))"
    return f"""
    transform(array({both}), a -> transform(array(sequence(0, cast((size(a) - 1) div {BLOCK} AS int))), k ->
      transform(array(aggregate(
          transform(k, i -> aggregate(slice(a, i * {BLOCK} + 1, {BLOCK}), 0, (s, x) -> s + x.g + x.m)),
          array(0), (s, n) -> concat(s, array(element_at(s, -1) + n)))), firsts ->
        flatten(transform(k, i -> aggregate(slice(a, i * {BLOCK} + 1, {BLOCK}),
          named_struct('at', firsts[i], 'out', cast(array() AS array<int>)),
          (s, x) -> named_struct('at', s.at + x.g + x.m, 'out', concat(s.out, array(s.at + x.g))),
          s -> s.out))))[0])[0])[0]"""


def _iban(run: str) -> str:
    """SQL: the valid beginning of a run that ends with a group, of registered
    length or else the longest; null if there is none."""
    part = f"substring({run}, 1, n)"
    ends = f"filter(sequence(15, length({run})), n -> substring({run}, n + 1, 1) IN ('', ' ') AND {_VALID['iban'].format(m=part)})"
    known = f"contains('{IBAN_LENGTHS}', concat(substring({run}, 1, 2), length(replace({part}, ' ', ''))))"
    return f"substring({run}, 1, array_max(transform({ends}, n -> named_struct('known', {known}, 'n', n))).n)"


def _proposals(text: str, kind: str, m: str) -> tuple[str, str]:
    """SQL: the matches of a kind, and its confirmed spans given the matches as column ``m``."""
    pattern = PATTERNS[kind].replace("'", "''")
    need = f"contains({text}, '{NEEDS[kind]}')" if kind in NEEDS else "true"
    matches = f"IF({need}, regexp_extract_all({text}, r'{pattern}', {int(kind == 'iban')}), cast(array() AS array<string>))"
    gaps = f"split({text}, r'{pattern}', -1)"
    if kind == "iban":
        matches = f"transform({matches}, m -> coalesce({_iban('m')}, m))"
        starts = _starts(gaps, f"transform({m}, m -> substring(m, 1, 2))")
    else:
        starts = _starts(gaps, m)
    # Most texts have no match and most matches are no card: positions only where one is valid.
    spans = f"""
    IF(exists({m}, m -> {_VALID[kind].format(m="m")}),
       filter(zip_with({m}, {starts},
                       (m, at) -> named_struct('kind', '{kind}', 'start', at, 'end', at + length(m), 'value', m)),
              x -> {_VALID[kind].format(m="x.value")}),
       cast(array() AS array<struct<kind:string,start:int,end:int,value:string>>))"""
    return matches, spans


def _scored(text: str, kind: str, spans: str) -> str:
    """SQL: spans with ``score``; added kinds only from the threshold up."""
    near = f"lower(concat(substring({text}, greatest(x.start - {CONTEXT_CHARS} + 1, 1), least(x.start, {CONTEXT_CHARS})), ' | '," \
           f" substring({text}, x.end + 1, {CONTEXT_CHARS})))"
    score = f"{PRIOR[kind]}D + IF(regexp_like({near}, r'{CONTEXT[kind]}'), {CONTEXT_BONUS}D, 0D)"
    if kind in DENIAL:
        score += f" - IF(regexp_like({near}, r'{DENIAL[kind]}'), {DENIAL_MALUS}D, 0D)"
    scored = f"transform({spans}, x -> named_struct('kind', x.kind, 'start', x.start, 'end', x.end, 'score'," \
             f" round(least(1D, greatest(0D, {score})), 3)))"
    return scored if kind in BASE_KINDS else f"filter({scored}, x -> x.score >= {THRESHOLD}D)"


def find_pii(docs: DataFrame, text_col: str = "text", spans_col: str = "pii_spans") -> DataFrame:
    """``docs`` with ``spans_col``: array of ``(kind, start, end, score)`` in code
    points, end exclusive, by kind as in KINDS, then start.

    Null and empty texts have no spans.  Rows that repeat and rows without an id
    are handled row by row.  A column called ``spans_col`` is replaced; other
    columns stay, whatever their names.
    """
    text = f"coalesce(`{text_col}`, '')"
    own = common.free_prefix(docs, "pii_of_")
    found = docs.drop(spans_col).withColumns({f"{own}m_{k}": F.expr(_proposals(text, k, f"{own}m_{k}")[0]) for k in KINDS})
    found = found.withColumns({f"{own}s_{k}": F.expr(_proposals(text, k, f"{own}m_{k}")[1]) for k in KINDS})
    all_spans = "concat(" + ", ".join(_scored(text, k, f"{own}s_{k}") for k in KINDS) + ")"
    return found.withColumn(spans_col, F.expr(all_spans)).drop(*[f"{own}{p}_{k}" for p in "ms" for k in KINDS])


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with every span of every kind replaced by ``[KIND]``.

    Overlapping spans become one, named after the first.  A null text stays
    null.  All columns stay; the text only changes where there is a span.
    """
    own = common.free_prefix(docs, "pii_in_")
    all_spans, cover = f"{own}spans", f"{own}cover"
    found = find_pii(docs, text_col, all_spans)
    # Cover: spans by start, each merged into the one before if they overlap.
    merged = F.expr(f"""aggregate(
        array_sort(transform({all_spans}, x -> named_struct('start', x.start, 'end', x.end, 'kind', upper(x.kind)))),
        cast(array() AS array<struct<start:int,end:int,kind:string>>),
        (acc, x) -> IF(size(acc) > 0 AND x.start < element_at(acc, -1).end,
           concat(slice(acc, 1, size(acc) - 1), array(named_struct('start', element_at(acc, -1).start,
              'end', greatest(element_at(acc, -1).end, x.end), 'kind', element_at(acc, -1).kind))),
           concat(acc, array(x))))""")
    pieces = F.expr(f"""concat(
        array_join(transform({cover}, (x, i) -> concat(
            substring(`{text_col}`, IF(i = 0, 0, {cover}[i - 1].end) + 1, x.start - IF(i = 0, 0, {cover}[i - 1].end)),
            '[', x.kind, ']')), ''),
        substring(`{text_col}`, element_at({cover}, -1).end + 1))""")
    return (found.withColumn(cover, merged)
            .withColumn(text_col, F.when(F.size(cover) > 0, pieces).otherwise(F.col(text_col)))
            .drop(all_spans, cover))


def q_op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, digest of the base spans, and all spans of every document."""
    found = find_pii(common.table(spark, sf_dir, "documents").select("doc_id", "text"))
    joined = "array_join(transform(filter(pii_spans, x -> {}), x -> concat_ws(':', x.kind, x.start, x.end)), ',')"
    base = "x.kind IN (" + ", ".join(f"'{k}'" for k in BASE_KINDS) + ")"
    return found.select(
        "doc_id",
        *[F.expr(f"cast(size(filter(pii_spans, x -> x.kind = '{k}')) AS bigint)").alias(f"n_{k}") for k in BASE_KINDS],
        F.expr(f"sha2({joined.format(base)}, 256)").alias("base_sha256"),
        F.expr(joined.format("true")).alias("spans"),
        F.expr("transform(pii_spans, x -> x.score)").alias("scores"),
    )
