"""Near-duplicate texts by a MinHash LSH forest.

A text's set is its distinct shingles of SHINGLE words.  Texts of equal sets are
one class.  Each class has TREES signatures of DEPTH minimum hashes; a tree is
the order of all classes by one of them.  Neighbours in that order share the
longest prefixes, so a class's candidates are the next classes that agree in
LEAST_PREFIX values: many classes with one prefix push those that agree in more
of it together, and the depth adapts to each region by itself.  The order is a
range sort over all tasks, cut anywhere, also amid equal signatures; what meets
at the cuts is compared in a second, small step.

Candidates whose sketches (a byte of each of SKETCH hashes) tell them apart are
dropped; the rest is confirmed on the full sets, made again from the texts of
the classes concerned.  First come next neighbours in FIRST_TREES trees, then
all candidates up to REACH places on in all trees that the first round has not
put into one component: a group of n copies costs about n confirmations.  A
region where more than REACH + 1 classes share a prefix is then dealt in blocks,
and every two blocks are compared whole by their sketches; few candidates are
written to be confirmed, of many only those links are that their sets confirm.
So every two classes with a common prefix in some tree are compared.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.llm import common, textarrays
from docweave.llm.components import components

SHINGLE = 5
SIMILARITY = 0.8
TREES, DEPTH = 16, 10
LEAST_PREFIX = 3
#: Places after a class in a tree's order that are compared; regions of more are compared in blocks.
REACH = 8
#: Mean rows of a block.
BLOCK = 1000
#: Candidates a row up to which two blocks' are written; of more, their sets are compared in place.
FEW = 4
#: Shingles whose occurrences are multiplied at a time.
COLUMNS = 4096
#: A byte of every hash: sets of SIMILARITY agree in 128 on average, deviation 5.1.
SKETCH = TREES * DEPTH
FIRST_TREES = 2
BITMAP_BITS = 26
SLICE_BYTES = 2 << 20
_rng = np.random.default_rng(20240607)
MULTIPLIERS = _rng.integers(1, 2**63, TREES * DEPTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: The hashes whose low bytes are the sketch: all.
SKETCHED = np.arange(SKETCH)


def shingles(hashes: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles, and the number of the first one of each text.  A
    text of fewer words than ``width`` has its whole sequence as the only one."""
    n = np.diff(first)
    count = np.where(n >= width, n - width + 1, np.minimum(n, 1))
    begin = np.concatenate([[0], np.cumsum(count)])
    at = np.arange(begin[-1]) - np.repeat(begin[:-1] - first[:-1], count)
    stop = np.minimum(at + width, np.repeat(first[1:], count))
    h = (stop - at).astype(np.uint64)
    for k in range(width):
        inside = at + k < stop
        h = np.where(inside, h * np.uint64(0x9E3779B97F4A7C15) + hashes[np.minimum(at + k, max(len(hashes) - 1, 0))], h) if len(hashes) else h
    return textarrays.mix(h), begin


def text_sets(texts: pa.Array, width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    data, offsets = textarrays.text_bytes(texts)
    starts, ends, first = textarrays.words(data, offsets)
    h, begin = shingles(textarrays.hash_runs(textarrays.LOWER[data], starts, ends), first, width)
    return [np.unique(h[a:b]) for a, b in zip(begin[:-1], begin[1:], strict=True)]


def set_key(items: np.ndarray) -> bytes:
    """A 128-bit name of a set."""
    a = textarrays.mix(items * np.uint64(0xD6E8FEB86659FD93)).sum(dtype=np.uint64)
    b = textarrays.mix(items ^ np.uint64(0xA5A5A5A5C3C3C3C3)).sum(dtype=np.uint64)
    return a.tobytes() + b.tobytes()


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """TREES x DEPTH minimum hashes (32 bits) of each set; sets must not be empty."""
    flat = np.concatenate(sets)
    begin = np.cumsum([0] + [len(s) for s in sets])[:-1]
    out = np.empty((len(sets), TREES * DEPTH), np.uint32)
    for i, m in enumerate(MULTIPLIERS):
        out[:, i] = np.minimum.reduceat(_high(flat * m), begin)
    return out


def sketch_least(similarity: float) -> int:
    """Sketches of sets this similar agree in fewer bytes once in ten thousand."""
    return math.floor(SKETCH * similarity - 3.72 * math.sqrt(SKETCH * similarity * (1 - similarity)))


def _high(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(32)).astype(np.uint32)


def describe(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """``(id, n, key, signature, sketch)`` per row; the last three are null for empty sets."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = src.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            sizes = np.diff(textarrays.text_bytes(batch.column(1))[1])
            for a, b in textarrays.slices(sizes, SLICE_BYTES):
                sets = text_sets(batch.column(1).slice(a, b - a), width)
                full = [i for i, s in enumerate(sets) if len(s)]
                rows = [[None] * len(sets) for _ in range(3)]
                if full:
                    sig = signatures([sets[i] for i in full])
                    whole, low = sig.astype(">u4"), (sig[:, SKETCHED] & 0xFF).astype(np.uint8)
                    for j, i in enumerate(full):
                        rows[0][i], rows[1][i], rows[2][i] = set_key(sets[i]), whole[j].tobytes(), low[j].tobytes()
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array([len(s) for s in sets], pa.int64()),
                                                  *(pa.array(r, pa.binary()) for r in rows)], names=["id", "n", "key", "signature", "sketch"])
        common.give_back()

    return common.written(src.mapInArrow(run, f"id {kind}, n long, key binary, signature binary, sketch binary"), "signatures")


_COLUMNS = ["tree", "path", "key", "n", "part", "sketch"]
_ROW = pa.schema([("a", pa.binary()), ("b", pa.binary()), ("tree", pa.int32()), ("path", pa.binary()), ("key", pa.binary()), ("n", pa.int64()),
                  ("part", pa.int64()), ("sketch", pa.binary())])


def _neighbours(tree, path, key, n, part, sketch, share: float, reach: int):
    """``(i, j)`` index arrays of the candidates among sorted rows."""
    found_i, found_j = [], []
    least = sketch_least(share)
    for step in range(1, reach + 1):
        if len(tree) <= step:
            break
        i, j = np.arange(len(tree) - step), np.arange(step, len(tree))
        near = (tree[i] == tree[j]) & (path[i, :4 * LEAST_PREFIX] == path[j, :4 * LEAST_PREFIX]).all(1)
        ok = near & (part[i] != part[j])
        agree = np.zeros(len(i), np.int64)
        agree[ok] = (sketch[i[ok]] == sketch[j[ok]]).sum(1)
        pick = ok & (agree >= least) & (np.minimum(n[i], n[j]) >= share * np.maximum(n[i], n[j]))
        found_i.append(i[pick])
        found_j.append(j[pick])
    empty = np.zeros(0, np.int64)
    return (np.concatenate(found_i), np.concatenate(found_j)) if found_i else (empty, empty)


def _columns(table: pa.Table):
    """Numpy forms of sorted rows."""
    fixed = lambda c, w: np.frombuffer(b"".join(table[c].to_pylist()), np.uint8).reshape(-1, w)
    return (table["tree"].to_numpy(), fixed("path", 4 * DEPTH), fixed("key", 16), table["n"].to_numpy(), table["part"].to_numpy(), fixed("sketch", SKETCH))


def candidates(classes: DataFrame, share: float, trees: range, reach: int) -> DataFrame:
    """``(a, b)``: pairs of class keys to confirm, neighbours up to ``reach``
    places apart in one of the trees and of different ``part``."""
    paths = F.array(*[F.struct(F.lit(t).alias("tree"), F.substring("signature", 1 + t * 4 * DEPTH, 4 * DEPTH).alias("path")) for t in trees])
    rows = classes.select("key", "n", "part", "sketch", F.explode(paths).alias("t")).select("t.tree", "t.path", "key", "n", "part", "sketch")
    parts = max(int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions")), classes.sparkSession.sparkContext.defaultParallelism * 2)
    order = ["tree", "path", "key"]

    def scan(edges: bool):
        def run(batches):
            last, head = None, True
            for batch in batches:
                table = pa.Table.from_batches([batch])
                if not len(table):
                    continue
                old = 0
                if last is not None:
                    table, old = pa.concat_tables([last, table]).combine_chunks(), len(last)
                i, j = _neighbours(*_columns(table), share, reach)
                new = j >= old
                i, j = i[new], j[new]
                key = table["key"]
                out = {"a": key.take(pa.array(i)), "b": key.take(pa.array(j)), "tree": table["tree"].take(pa.array(i))}
                none = pa.nulls(len(i), pa.binary())
                number = pa.nulls(len(i), pa.int64())
                yield from pa.table([out["a"], out["b"], out["tree"], none, none, number, number, none], schema=_ROW).to_batches()
                if edges and head:
                    yield from _edge(table.slice(0, REACH))
                    head = False
                last = table.slice(max(0, len(table) - REACH))
            if edges and last is not None:
                yield from _edge(last)

        return run

    def _edge(rows: pa.Table):
        none = pa.nulls(len(rows), pa.binary())
        return pa.table([none, none, *(rows[c] for c in _COLUMNS)], schema=_ROW).combine_chunks().to_batches()

    schema = "a binary, b binary, tree int, path binary, key binary, n long, part long, sketch binary"
    # The key is part of the order, so that classes with one signature are cut too.
    ranged = rows.select(*_COLUMNS).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    first = common.written(ranged.mapInArrow(scan(True), schema), "forest")
    # At most 2 x REACH rows per task.
    cuts = first.where("a IS NULL").select(*_COLUMNS).distinct().repartition(1).sortWithinPartitions(*order)
    pairs = first.where("a IS NOT NULL").select("a", "b").unionByName(cuts.mapInArrow(scan(False), schema).select("a", "b"))
    return common.written(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "candidates")


def sets_of(docs: DataFrame, id_col: str, text_col: str, width: int, wanted: DataFrame) -> DataFrame:
    """``(key, items)`` of the classes ``wanted (rep, key)``, from the texts of
    their first rows.  A bitmap of the ids, of fixed size, spares the other texts."""
    kind = docs.schema[id_col].dataType.simpleString()
    hashed = F.xxhash64("id")
    bits = common.bitmap(wanted.select(F.col("rep").alias("id")).select(hashed.alias("hash")), "hash", BITMAP_BITS)
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).select("id", "text", hashed.alias("hash"))

    def run(batches):
        for batch in batches:
            keep = common.in_bitmap(bits, batch.column(2).to_numpy().view(np.uint64))
            batch = batch.filter(pa.array(keep))
            sizes = np.diff(textarrays.text_bytes(batch.column(1))[1])
            for a, b in textarrays.slices(sizes, SLICE_BYTES):
                sets = text_sets(batch.column(1).slice(a, b - a), width)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array([set_key(s) for s in sets], pa.binary()),
                                                  pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], names=["id", "key", "items"])
        common.give_back()

    found = src.mapInArrow(run, f"id {kind}, key binary, items array<bigint>")
    return common.written(found.join(wanted.withColumnRenamed("rep", "id"), ["id", "key"], "left_semi")
                          .dropDuplicates(["id", "key"]).select("key", "items"), "sets")


def confirm(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    left = pairs.select("a", "b").join(sets.select(F.col("key").alias("a"), F.col("items").alias("x")), "a")
    both = left.join(sets.select(F.col("key").alias("b"), F.col("items").alias("y")), "b")
    both = both.withColumn("common", F.size(F.array_intersect("x", "y")))
    percent = round(100 * similarity)
    return common.written(both.where(f"100L * common >= {percent}L * (size(x) + size(y) - common)").select("a", "b"), "confirmed")


def _prefixes(trees: range):
    """Column: the prefixes of a signature, one after another."""
    return F.concat(*[F.substring("signature", 1 + t * 4 * DEPTH, 4 * LEAST_PREFIX) for t in trees])


def _units(batches):
    """One table for each unit, of batches sorted by ``unit``."""
    last = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if last is not None:
            table = pa.concat_tables([last, table])
        if not len(table):
            continue
        unit = table["unit"].combine_chunks()
        cuts = np.flatnonzero(pc.not_equal(unit.slice(1), unit.slice(0, len(unit) - 1)).to_numpy(zero_copy_only=False)) + 1
        bounds = [0, *cuts.tolist()]
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            yield table.slice(a, b - a)
        last = table.slice(bounds[-1])
    if last is not None:
        yield last


def _sides(table: pa.Table):
    """Row numbers of the two blocks, and which pairs are of different parts; a
    block with itself has each pair once."""
    side, part = table["side"].to_numpy(), table["part"].to_numpy()
    x, y = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    if len(y):
        return x, y, part[x][:, None] != part[y]
    return x, x, np.triu(part[x][:, None] != part[x], 1)


def _alike(table: pa.Table, share: float):
    """``(i, j)``: rows of different parts whose sketches don't tell them apart."""
    x, y, ok = _sides(table)
    n, sketch = table["n"].to_numpy(), np.frombuffer(b"".join(table["sketch"].to_pylist()), np.uint8).reshape(-1, SKETCH)
    ok &= np.minimum(n[x][:, None], n[y]) >= share * np.maximum(n[x][:, None], n[y])
    if len(x) * len(y) < 4096:
        agree = (sketch[x][:, None, :] == sketch[y]).sum(2)
    else:
        agree, left, right = np.zeros(ok.shape, np.uint8), sketch[x].T.copy(), sketch[y].T.copy()
        for a, b in zip(left, right, strict=True):
            agree += a[:, None] == b
    i, j = np.nonzero(ok & (agree >= sketch_least(share)))
    return x[i], y[j]


def _in_common(sets: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The sizes of the intersections of the sets ``x`` with the sets ``y``."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, at, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = np.flatnonzero(count[at] > 1)
    shared = shared[np.argsort(at[shared], kind="stable")]
    owner, at = owner[shared], np.unique(at[shared], return_inverse=True)[1]
    out = np.zeros((len(x), len(y)), np.float32)
    for begin in range(0, int(at[-1]) + 1 if len(at) else 0, COLUMNS):
        a, b = np.searchsorted(at, [begin, begin + COLUMNS])
        holds = np.zeros((len(sets), COLUMNS), np.float32)
        holds[owner[a:b], at[a:b] - begin] = 1
        out += holds[x] @ holds[y].T
    return out.astype(np.int64)


def _links(table: pa.Table, percent: int):
    """``(i, j)``: links that tie together all that the similar pairs of a unit
    do.  A pair counts in the first tree in which its prefixes are the same."""
    x, y, ok = _sides(table)
    prefix = np.frombuffer(b"".join(table["prefixes"].to_pylist()), np.uint32).reshape(-1, TREES, LEAST_PREFIX)
    for t in range(table["tree"][0].as_py()):
        same = np.ones(ok.shape, bool)
        for k in range(LEAST_PREFIX):
            same &= prefix[x, t, k][:, None] == prefix[y, t, k]
        ok &= ~same
    if not ok.any():
        return
    sets = [s.values.to_numpy() for s in table["items"]]
    n = np.array([len(s) for s in sets])
    both = _in_common(sets, x, y)
    ok &= 100 * both >= percent * (n[x][:, None] + n[y] - both)
    label = table["part"].to_numpy().copy()
    for a in np.flatnonzero(ok.any(1)):
        i, js = x[a], y[ok[a]]
        others, first = np.unique(label[js], return_index=True)
        fresh = others != label[i]
        if fresh.any():
            yield from ((i, j) for j in js[first[fresh]])
            label[np.isin(label, others[fresh])] = label[i]


def crowded(classes: DataFrame, share: float) -> tuple[DataFrame, DataFrame]:
    """``(a, b)``: pairs to confirm of the regions with more classes than the
    scans reach, and ``(unit, tree, key, part, side)`` of the blocks with too
    many pairs to write them."""
    paths = F.array(*[F.struct(F.lit(t).alias("tree"), _prefixes(range(t, t + 1)).alias("prefix")) for t in range(TREES)])
    rows = classes.select("key", "n", "part", "sketch", F.explode(paths).alias("t")).select("t.tree", "t.prefix", "key", "n", "part", "sketch")
    # Written before the join, so that a large region's rows can be split.
    regions = rows.groupBy("tree", "prefix").agg(F.count("*").alias("size"), F.min("part").alias("low"), F.max("part").alias("high"))
    regions = common.written(regions.where(f"size > {REACH + 1} AND low < high").select(
        "tree", "prefix", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks")), "regions")
    dealt = rows.join(regions, ["tree", "prefix"]).withColumn("block", F.expr("cast(pmod(xxhash64(key), blocks) AS int)"))
    dealt = dealt.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    unit = F.concat_ws("-", "tree", F.hex("prefix"), F.least("block", "other"), F.greatest("block", "other"))
    dealt = dealt.select(unit.alias("unit"), "tree", "key", "n", "part", "sketch", F.expr("IF(block > other, 1, 0)").alias("side"))
    parts = max(int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions")), classes.sparkSession.sparkContext.defaultParallelism * 2)
    fields = pa.schema([("a", pa.binary()), ("b", pa.binary()), ("unit", pa.string()), ("tree", pa.int32()), ("key", pa.binary()),
                        ("part", pa.int64()), ("side", pa.int32())])

    def run(batches):
        for table in _units(batches):
            i, j = _alike(table, share)
            if len(i) <= FEW * len(table):
                pairs = [table["key"].take(pa.array(k)).cast(pa.binary()) for k in (i, j)]
                empty = [pa.nulls(len(i), f.type) for f in list(fields)[2:]]
            else:
                some = table.take(pa.array(np.union1d(i, j)))
                pairs = [pa.nulls(len(some), pa.binary())] * 2
                empty = [some[c] for c in fields.names[2:]]
            yield from pa.table([*pairs, *empty], schema=fields).to_batches()
        common.give_back()

    out = dealt.repartition(parts, "unit").sortWithinPartitions("unit").mapInArrow(
        run, "a binary, b binary, unit string, tree int, key binary, part long, side int")
    out = common.written(out, "crowded")
    pairs = out.where("a IS NOT NULL").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    return common.written(pairs, "candidates"), out.where("unit IS NOT NULL").drop("a", "b")


def crowded_links(crowds: DataFrame, classes: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """``(a, b)``: links among the rows of ``crowds``, compared by their full sets."""
    percent = round(100 * similarity)
    rows = crowds.join(classes.select("key", _prefixes(range(TREES)).alias("prefixes")), "key").join(sets, "key")
    parts = max(int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions")), classes.sparkSession.sparkContext.defaultParallelism * 2)

    def run(batches):
        for table in _units(batches):
            found = np.array(list(_links(table, percent)), np.int64).reshape(-1, 2)
            keys = [table["key"].take(pa.array(k)) for k in found.T]
            yield from pa.table(keys, names=["a", "b"]).to_batches()
        common.give_back()

    rows = rows.select("unit", "tree", "key", "part", "side", "prefixes", "items").repartition(parts, "unit").sortWithinPartitions("unit")
    return common.written(rows.mapInArrow(run, "a binary, b binary"), "crowded-links")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE,
                    similarity: float = SIMILARITY) -> DataFrame:
    """``(id_col, n_shingles, component_id, kept)`` per row of ``docs``.

    Words are what lies between ASCII white space, A-Z in lower case.  A null or
    empty text, or one of white space, has an empty set and is linked with
    nothing.  Rows that repeat an id are one node with the links of all of them;
    a row without an id has null ``component_id`` and ``kept``.  An empty table
    gives no rows; other columns are ignored.
    """
    rows = describe(docs, id_col, text_col, width)
    solid = rows.where("key IS NOT NULL AND id IS NOT NULL")
    classes = common.written(solid.groupBy("key").agg(F.min("id").alias("rep")), "classes")
    # One row per class, the first; rows that repeat it are equal.
    firsts = solid.dropDuplicates(["id", "key"]).join(classes.withColumnRenamed("rep", "id"), ["id", "key"], "left_semi")
    firsts = common.written(firsts.select("id", "key", "n", "signature", "sketch"), "firsts")

    def wanted_sets(keys):
        return sets_of(docs, id_col, text_col, width, common.written(keys.distinct().join(classes, "key").select("rep", "key"), "wanted"))

    def named_links(pairs):
        return (pairs.join(classes.select(F.col("key").alias("a"), F.col("rep").alias("u")), "a")
                .join(classes.select(F.col("key").alias("b"), F.col("rep").alias("v")), "b").select("u", "v"))

    def confirmed(pairs):
        return named_links(confirm(pairs, wanted_sets(pairs.select(F.explode(F.array("a", "b")).alias("key"))), similarity))

    def placed():
        return firsts.join(parts, "id", "left").withColumn("part", F.xxhash64(F.coalesce("component", "id")))

    def joined(links):
        return common.written(components(parts.select(F.col("id").alias("u"), F.col("component").alias("v")).unionByName(links)), "components")

    links = confirmed(candidates(firsts.withColumn("part", F.xxhash64("key")), similarity, range(FIRST_TREES), 1))
    parts = common.written(components(links), "components")
    parts = joined(confirmed(candidates(placed(), similarity, range(TREES), REACH)))
    pairs, crowds = crowded(placed(), similarity)
    more = links.limit(0)
    if not pairs.isEmpty():
        more = more.unionByName(confirmed(pairs))
    if not crowds.isEmpty():
        sets = wanted_sets(crowds.select("key"))
        more = more.unionByName(named_links(crowded_links(crowds, firsts, sets, similarity)))
    # Ids that occur in several classes tie these together.
    tied = solid.join(classes, "key").where("id <> rep").select(F.col("id").alias("u"), F.col("rep").alias("v")).distinct()
    repeated = rows.where("id IS NOT NULL").groupBy("id").agg(F.count_distinct("key").alias("n")).where("n > 1").select(F.col("id").alias("u"))
    tied = tied.join(repeated, "u", "left_semi")
    parts = components(parts.select(F.col("id").alias("u"), F.col("component").alias("v")).unionByName(more).unionByName(tied))
    named = common.written(classes.join(parts.withColumnRenamed("id", "rep"), "rep", "left").select(
        "key", F.coalesce("component", "rep").alias("component_id")), "class-components")
    # A row's class; rows of empty sets are on their own.
    out = rows.select("id", "n", "key").join(named, "key", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"), (F.col("id") == component).alias("kept"))


def q_op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents with similar sets of two-word shingles."""
    return near_duplicates(common.spread(common.table(spark, sf_dir, "documents").select("doc_id", "text")), width=2)


common.by_value(__name__)
