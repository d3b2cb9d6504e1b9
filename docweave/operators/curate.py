"""A1, A2, P2–P5, S8 core — dedupe, last-wins, tolerant parsing, sanitize.

Both "keep one row per key" operators work in two passes: a narrow one over a
digest of the key and the order fields (a partial and a final aggregate, so a
key that holds a third of all rows is collapsed on every mapper), then a
hash semi-join that keeps the winning rows.  Whole rows are never sorted, but
the semi-join deals them by key.  With ``by_address`` they stay where they are:
the first pass also finds the winner's address, and only the winners are read
again (``sources/addressed.py``); choose it for wide rows and hot keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docweave.functions.text import clean_text
from docweave.operators.extract import ENTITY_SCHEMA
from docweave.sources.addressed import FILE, ROW, fetch, with_addresses

# Category precedence when the same key appears in several
# categories (the order the four entity folders are read).
CATEGORY_ORDER = ["editor", "developer", "plugins", "runtime"]


def category_rank(c: Column) -> Column:
    expr = None
    for i, name in enumerate(CATEGORY_ORDER):
        expr = F.when(c == name, F.lit(i)) if expr is None else expr.when(c == name, F.lit(i))
    return expr.otherwise(F.lit(len(CATEGORY_ORDER)))


def non_empty(c: Column) -> Column:
    """P5: ``if key`` — not null and not empty."""
    return c.isNotNull() & (c != "")


def _digest(key: list[str]) -> Column:
    return F.md5(F.to_json(F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(key)])))


def _winners_by_address(df: DataFrame, key: list[str], order: list[Column], best) -> DataFrame:
    """As ``_winners``, without an exchange of whole rows.  Of rows that tie, the
    first (min) or the last (max) by address stays."""
    rows = with_addresses(df)
    rank = order[0] if len(order) == 1 else F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)])
    # A row without an order field comes after all others, either way.
    last = rank.isNull() if best is F.min else rank.isNotNull()
    ranked = rows.select(_digest(key).alias("__k"), F.struct(last.alias("n"), rank.alias("o"), F.col(FILE), F.col(ROW)).alias("__o"))
    return fetch(ranked.groupBy("__k").agg(best("__o").alias("b")).select("b.*"), df)


def _winners(df: DataFrame, key: list[str], order: list[Column], best, unique_order: bool) -> DataFrame:
    """The rows of ``df`` whose order fields are ``best`` (min or max) of their key."""
    digest = _digest(key)
    # One plain field aggregates by hashing; a struct is sorted, but only these narrow rows.
    rank = order[0] if len(order) == 1 else F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)])
    ranked = df.withColumn("__k", digest).withColumn("__o", rank)
    first = ranked.groupBy("__k").agg(best("__o").alias("__b")).withColumnRenamed("__k", "__key").hint("shuffle_hash")
    kept = ranked.join(first, (F.col("__k") == F.col("__key")) & F.col("__o").eqNullSafe(F.col("__b")), "left_semi").drop("__o")
    return (kept if unique_order else kept.dropDuplicates(["__k"])).drop("__k")


def dedupe(df: DataFrame, key: list[str] | tuple[str, ...] = ("source_path",), order: list[Column] | None = None,
           unique_order: bool = False, by_address: bool = False) -> DataFrame:
    """A1: one row per key, the first in ``order`` wins; empty keys dropped.

    ``order`` defaults to ``(category precedence, line)`` when the frame has
    those columns.  ``unique_order`` states that no two rows of a key are equal
    in ``order`` (line numbers), which spares a last pass.
    """
    key = list(key)
    if order is None:
        order = []
        if "category" in df.columns:
            order.append(category_rank(F.col("category")))
        if "line" in df.columns:
            order.append(F.col("line"))
    types = dict(df.dtypes)
    for k in key:
        df = df.filter(non_empty(F.col(k)) if types[k] == "string" else F.col(k).isNotNull())
    if by_address:
        return _winners_by_address(df, key, order or [F.lit(0)], F.min)
    if not order:
        return df.dropDuplicates(key)
    return _winners(df, key, order, F.min, unique_order)


def last_wins(df: DataFrame, key: str, order: Column | str, unique_order: bool = False, by_address: bool = False) -> DataFrame:
    """A2: dict-overwrite semantics — per key (null is a key), the row latest in ``order``."""
    order = F.col(order) if isinstance(order, str) else order
    return _winners_by_address(df, [key], [order], F.max) if by_address else _winners(df, [key], [order], F.max, unique_order)


def parse_entity_lines(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """NDJSON lines → typed entities + ``_keys`` (keys present) + ``_bad``.

    A line is bad when it is not a JSON object (``json_object_keys`` is null);
    a bad line is reported (Q5) and skipped, never fails the job.
    """
    v = F.col(value_col)
    keys = F.json_object_keys(v)
    parsed = F.from_json(v, ENTITY_SCHEMA, {"mode": "PERMISSIVE"})
    nav_raw = F.get_json_object(v, "$.navigation")
    return lines.select(
        *[c for c in lines.columns if c != value_col], v.alias(value_col),
        parsed.alias("_e"), keys.alias("_keys"), keys.isNull().alias("_bad"),
        F.when(F.startswith(F.ltrim(nav_raw), F.lit("[")), F.lit(True)).otherwise(F.lit(False)).alias("_nav_is_list"),
    )


def good_entities(parsed: DataFrame) -> DataFrame:
    keep = [c for c in parsed.columns if not c.startswith("_") and c != "value"]
    return parsed.filter(~F.col("_bad")).select(*keep, "_e.*")


def bad_lines(parsed: DataFrame, value_col: str = "value") -> DataFrame:
    keep = [c for c in parsed.columns if not c.startswith("_") and c != value_col]
    return parsed.filter(F.col("_bad")).select(*keep, F.col(value_col).alias("raw"), F.lit("malformed JSON line").alias("error"))


# The sanitized record — its fields in order and the default
# used for a *missing* key.
SANITIZED_FIELDS = ["name", "short_description", "navigation", "module", "header", "include", "syntax", "remarks",
                    "entity_type", "source_path"]
SANITIZE_DEFAULTS = {"name": "", "short_description": "", "navigation": [], "module": "", "header": "", "include": "",
                     "syntax": "", "remarks": "", "entity_type": "unknown", "source_path": ""}


def sanitize(parsed: DataFrame) -> DataFrame:
    """Project to the 10 fixed fields; a *missing* key gets its default, a
    present null stays null (D4); strings are cleaned (P3); a navigation that
    is not a list (null included) becomes ``[]``; its items are not cleaned."""
    keep = [c for c in parsed.columns if not c.startswith("_") and c != "value"]
    cols = []
    for f in SANITIZED_FIELDS:
        present = F.coalesce(F.array_contains(F.col("_keys"), F.lit(f)), F.lit(False))
        if f == "navigation":
            val = F.when(F.col("_nav_is_list"), F.coalesce(F.col("_e.navigation"), F.array().cast("array<string>"))).otherwise(
                F.array().cast("array<string>"))
            cols.append(val.alias(f))
            continue
        raw = F.col(f"_e.{f}")
        cleaned = F.when(raw.isNull(), F.lit(None).cast("string")).otherwise(clean_text(raw))
        cols.append(F.when(present, cleaned).otherwise(F.lit(SANITIZE_DEFAULTS[f])).alias(f))
    return parsed.filter(~F.col("_bad")).select(*keep, *cols)


def sanitize_errors(parsed: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Count of lines that could not be parsed (per ``by`` group)."""
    by = by or []
    return parsed.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_lines"), F.count_if(F.col("_bad")).cast("long").alias("n_errors")
    )
