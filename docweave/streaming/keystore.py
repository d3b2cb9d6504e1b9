"""W2, J6 — keys seen so far, on disk instead of in streaming state.

Keys are rows of a published table, dealt to ``PARTS`` folders by their hash.
Beside them lies a Bloom filter in pieces of 32,768 bits: a key's hash names its
piece and ``BITS`` places in it.  A batch meets the pieces of its own keys first;
what a piece has not seen is new, and only the rest (keys seen before, and about
one new key in a hundred) is compared with the stored keys, in the folders that
it falls into.  So no operator of a stream keeps state, and what a micro-batch
reads of old keys does not depend on how many new ones it brings.

When a piece holds more than ``PIECE_KEYS`` keys on average, the filter is built
anew with twice as many pieces: once per doubling of the store.  Until then a
fuller filter lets more keys through to the comparison and changes no result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docweave.sources.published import PublishedTables

PARTS = 64
BITS = 7
PIECE_KEYS = 3276
PIECE_BITS = 32768
_HASH, _PART = "key_hash", "key_part"


def bit_at(bits: str, place: Column) -> Column:
    """Whether a bit of a bitmap (``bitmap_construct_agg``) is set."""
    byte = F.conv(F.hex(F.substring(bits, (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.call_function("shiftright", byte, F.pmod(place, F.lit(8)).cast("int")).bitwiseAND(F.lit(1)) == 1


class KeyStore:
    """The keys ``key`` (columns; nulls are equal) in the tables ``keys`` and
    ``filters`` of ``tables``."""

    def __init__(self, tables: PublishedTables, key: list[str]):
        self.tables, self.key = tables, list(key)

    def _hashed(self, rows: DataFrame) -> DataFrame:
        h = F.xxhash64(*[F.col(c) for c in self.key])
        return rows.withColumn(_HASH, h).withColumn(_PART, F.pmod(F.col(_HASH), F.lit(PARTS)).cast("int"))

    @staticmethod
    def _places(pieces: int) -> tuple[Column, list[Column]]:
        """The piece of a hash and its places there: two more hashes, combined."""
        a, b = F.xxhash64(F.col(_HASH), F.lit(1)), F.xxhash64(F.col(_HASH), F.lit(2))
        step = F.pmod(b, F.lit(PIECE_BITS // 2)) * 2 + 1
        piece = F.pmod(F.xxhash64(F.col(_HASH), F.lit(3)), F.lit(pieces))
        return piece, [F.pmod(F.pmod(a, F.lit(PIECE_BITS)) + i * step, F.lit(PIECE_BITS)) for i in range(BITS)]

    def _filter(self, hashes: DataFrame, pieces: int) -> DataFrame:
        piece, places = self._places(pieces)
        bits = hashes.select(piece.alias("piece"), F.explode(F.array(*places)).alias("place"))
        return bits.groupBy("piece").agg(F.bitmap_construct_agg("place").alias("bits"))

    @staticmethod
    def _merged(filters: DataFrame) -> DataFrame:
        return filters.groupBy("piece").agg(F.bitmap_or_agg("bits").alias("bits"))

    def new(self, rows: DataFrame) -> DataFrame:
        """The rows whose key is not stored; their columns, and the hash and the
        folder of the key.  ``rows`` holds a key once and is read more than once."""
        m, hashed = self.tables.manifest(), self._hashed(rows)
        if "keys" not in m["tables"]:
            return hashed
        piece, places = self._places(m["notes"]["pieces"])
        filters = self._merged(self.tables.read("filters", m["version"]))
        by_piece = hashed.withColumn("_piece", piece).join(filters, F.col("_piece") == F.col("piece"), "left")

        maybe = F.col("piece").isNotNull() & reduce(Column.__and__, [bit_at("bits", p) for p in places])
        marked = by_piece.withColumn("_maybe", maybe).drop("_piece", "piece", "bits")
        passed = marked.filter("_maybe").drop("_maybe")
        parts = [r[0] for r in passed.select(_PART).distinct().collect()]  # at most PARTS numbers
        stored = self.tables.read("keys", m["version"]).filter(F.col(_PART).isin(parts) if parts else F.lit(False))
        other = stored.select(_HASH, *self.key).toDF("_h", *[f"_k{i}" for i in range(len(self.key))])
        same = [F.col(_HASH) == F.col("_h")] + [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(self.key)]
        return marked.filter("NOT _maybe").drop("_maybe").unionByName(passed.join(other, reduce(Column.__and__, same), "left_anti"))

    def stage(self, new: DataFrame) -> tuple[list[dict], DataFrame, dict]:
        """Write the rows of ``new`` and their filter, not shown yet: the sets,
        the rows read back, and the notes to commit them with."""
        m = self.tables.manifest()
        pieces, stored = m["notes"].get("pieces", 0), m["notes"].get("n_keys", 0)
        keys = self.tables.stage("keys", new.repartition(_PART), [_PART])
        written = self.tables.read_staged(keys)
        n_keys = stored + written.count()
        wanted = pieces or 1
        while wanted * PIECE_KEYS < n_keys:
            wanted *= 2
        rebuilt = wanted != pieces
        hashes = written.select(_HASH)
        if rebuilt and stored:
            hashes = hashes.union(self.tables.read("keys", m["version"]).select(_HASH))
        filters = self.tables.stage("filters", self._filter(hashes, wanted))
        return [keys, filters], written, {"pieces": wanted, "n_keys": n_keys, "rebuilt": rebuilt}

    def commit(self, sets: list[dict], notes: dict, stream: str, batch: int) -> None:
        """Show the staged keys and filter, and the sets beside them.  One stream
        at a time may add keys to a store."""
        replace = ["filters"] if notes.pop("rebuilt") else []
        self.tables.commit(sets, stream, batch, replace, notes)

    def compact(self) -> None:
        self.tables.compact("keys")
        self.tables.compact("filters", arrange=self._merged)
