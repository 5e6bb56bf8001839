"""Near-duplicates by a MinHash LSH forest.

A document is its set of word shingles. Documents with equal sets are one class, and only the smallest id of a class goes on. Each tree of the forest
sorts the signatures from another starting value; documents whose signatures begin alike lie side by side, the longer their common prefix the
closer. Two common values make documents neighbours in a region; inside it, order by the further values gives each its neighbours with
the longest common prefix. Documents alone in their regions need no more work. For the rest the full sets travel, region by region: a region of at most
``REGION_ROWS`` documents and ``REGION_ITEMS`` shingles lies whole in one task, where every document is compared with all others through an index of
the shingles that gives full intersections. Of the links found, those between documents not yet connected go on. Components are found by min-label rounds with shortcuts, all in Spark.

Larger regions are cut along their sorted order into pieces of that size, so that neighbours with long common prefixes stay together, and each piece is compared as a region is.
What is not one component then is finished exactly. First every piece meets the region's pivots (its longest documents, at most ``PIVOTS``, of different components), which joins
large families in one go. Then the documents, sorted by component, are dealt into blocks, and every block meets every block of its region, but for those
that are wholly of one component. So each pair in a region is compared or known to be connected, at any size of the region; the work grows with the square only of what stays unconnected.

Two documents of similarity s share a region in none of the trees with chance (1 - s ** SHARED) ** TREES, 3e-6 at 0.85; tests measure recall against brute force.

Defined results: null and empty texts have an empty set and are linked with nothing; a text of fewer words than a shingle is one shingle; repeated rows share a
component; rows with one id and different texts are compared each by its own text; a null id takes part with the smallest id of its class; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.exprs import c
from riskloom.functions.joins import freeze
from riskloom.llm.common import Words, mix64, narrow, parts_for, shingles, text_runs
from riskloom.session import materialize

TREES = 10
VALUES_PER_TREE = 6
DEPTH = 8  # signature values a tree is sorted by; equal ones are ordered by id
SHARED = 2  # values at the front that the documents of a region have in common
REGION_ITEMS = 1_000_000  # shingles that one comparison holds, about 60 MB
REGION_ROWS = 4_000
PIVOTS = 32
ITEM_BYTES = 6  # of each shingle hash, when full sets travel: two sets of 1,000 mix up a pair with chance 1e-8

_VALUES = TREES * VALUES_PER_TREE
_RNG = np.random.default_rng(77)
_XOR = _RNG.integers(0, 2**32, _VALUES, dtype=np.uint32)
_ODD = _RNG.integers(0, 2**31, _VALUES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def shingle_sets(texts: list[bytes], k: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    runs, of = shingles(Words(texts), k)
    order = np.argsort(of, kind="stable")
    cuts = np.searchsorted(of[order], np.arange(len(texts) + 1))
    runs = runs[order]
    return [np.unique(runs[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]


def signature(items: np.ndarray) -> bytes:
    """MinHash values, big-endian, so that bytes sort like numbers."""
    low = (items >> np.uint64(32)).astype(np.uint32)
    best = np.full(_VALUES, 0xFFFFFFFF, dtype=np.uint32)
    for start in range(0, len(low), 4_096):
        best = np.minimum(best, ((low[start:start + 4_096, None] ^ _XOR) * _ODD).min(axis=0))
    return best.astype(">u4").tobytes()


def digest(items: np.ndarray) -> bytes:
    """128 bits that do not depend on the order of the items."""
    with np.errstate(over="ignore"):
        return np.array([mix64(items).sum(dtype=np.uint64), mix64(items ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64)]).tobytes()


def _signatures(rows: DataFrame, k: int) -> DataFrame:
    """doc_id, mark (of the text), n_shingles, digest, signature of rows (doc_id, text, mark)."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop, texts in text_runs(batch.column("text")):
                part, sets = batch.slice(start, stop - start), shingle_sets(texts, k)
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), part.column("mark"), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([digest(s) if len(s) else None for s in sets], pa.binary()), pa.array([signature(s) if len(s) else None for s in sets], pa.binary())],
                    ["doc_id", "mark", "n_shingles", "digest", "signature"])

    return rows.mapInArrow(work, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, mark string, n_shingles long, digest binary, signature binary")


def pack(items: np.ndarray) -> bytes:
    """The upper bytes of sorted hashes."""
    return (items >> np.uint64(64 - 8 * ITEM_BYTES)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :ITEM_BYTES].tobytes()


def unpack(packed: bytes) -> np.ndarray:
    out = np.zeros((len(packed) // ITEM_BYTES, 8), dtype=np.uint8)
    out[:, :ITEM_BYTES] = np.frombuffer(packed, dtype=np.uint8).reshape(-1, ITEM_BYTES)
    return out.view("<u8").reshape(-1)


def _with_sets(placed: DataFrame, k: int) -> DataFrame:
    """Rows (doc_id, text, digest, places) with the packed set in place of the text; of several texts under one id, those of the digest."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop, texts in text_runs(batch.column("text")):
                part, sets = batch.slice(start, stop - start), shingle_sets(texts, k)
                own = pa.array([wanted is None or digest(s) == wanted for s, wanted in zip(sets, part.column("digest").to_pylist())], pa.bool_())
                out = pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("places"), pa.array([pack(s) for s in sets], pa.binary())], ["doc_id", "places", "items"])
                yield out.filter(own)

    kinds = {n: placed.schema[n].dataType.simpleString() for n in ("doc_id", "places")}
    return placed.select("doc_id", "places", "text", "digest").mapInArrow(work, f"doc_id {kinds['doc_id']}, places {kinds['places']}, items binary")


def region_links(docs: list, sets: list[np.ndarray], percent: int) -> Iterator[tuple]:
    """(a, b) for pairs of documents that are alike and not yet connected; every pair is compared on full sets."""
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    joined = np.concatenate(sets)
    order = np.argsort(joined, kind="stable")
    values = joined[order]
    first = np.append(True, values[1:] != values[:-1])
    starts = np.flatnonzero(first)
    counts = np.diff(np.append(starts, len(values)))
    group = np.cumsum(first) - 1
    owners = np.repeat(np.arange(len(sets), dtype=np.int32), sizes)[order]  # ascending within a value
    del joined, values, first
    # of each document: where its values lie in the sorted order, but for those that no other document has
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.arange(len(order))
    ends = np.cumsum(sizes)
    parent = list(range(len(docs)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    for me in range(1, len(docs)):
        at = place[ends[me] - sizes[me]:ends[me]]
        at = at[counts[group[at]] > 1]
        begin = starts[group[at]]
        before = at - begin  # owners of the value that come before this document
        some = before > 0
        begin, before = begin[some], before[some]
        total = int(before.sum())
        if not total:
            continue
        within = np.arange(total) - np.repeat(np.cumsum(before) - before, before)
        common = np.bincount(owners[np.repeat(begin, before) + within], minlength=me)
        for other in np.flatnonzero(100 * common >= percent * (sizes[:me] + sizes[me] - common)).tolist():
            if root(other) != root(me):
                parent[root(other)] = root(me)
                yield docs[other], docs[me]


def _links(placed: DataFrame, percent: int) -> DataFrame:
    """Verified links of rows (piece, tree, key, doc_id, items) that come sorted, region by region."""
    kind = placed.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, docs, sets = None, [], []
        for batch in batches:
            found = []
            columns = [batch.column(name) for name in ("piece", "tree", "key", "doc_id", "items")]
            for i in range(batch.num_rows):
                piece, tree, key, doc, items = (col[i].as_py() for col in columns)
                if at != (piece, tree, key[:4 * SHARED]):
                    found += region_links(docs, sets, percent) if docs else []
                    at, docs, sets = (piece, tree, key[:4 * SHARED]), [], []
                docs.append(doc)
                sets.append(unpack(items))
            yield _pairs(found, batch.schema.field("doc_id").type)
        if docs:
            yield _pairs(list(region_links(docs, sets, percent)), columns[3].type)

    return placed.select("piece", "tree", "key", "doc_id", "items").mapInArrow(work, f"a {kind}, b {kind}")


def _pairs(found: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([min(p) for p in found], kind), pa.array([max(p) for p in found], kind)], ["a", "b"])


class _Block:
    """Documents of one side of a pair of blocks, and who is connected with whom on both sides."""

    def __init__(self, percent: int):
        self.percent = percent
        self.docs: list = []
        self.sets: list[np.ndarray] = []
        self.groups: dict = {}
        self.of: list[int] = []
        self.joined: dict[int, int] = {}
        self.values: np.ndarray | None = None

    def _group(self, component) -> int:
        at = self.groups.setdefault(component, len(self.groups))
        while at in self.joined:
            at = self.joined[at]
        return at

    def add(self, doc, component, items: np.ndarray) -> None:
        self.docs.append(doc)
        self.sets.append(items)
        self.of.append(self._group(component))

    def _build(self) -> None:
        sizes = np.array([len(s) for s in self.sets])
        joined = np.concatenate(self.sets)
        order = np.argsort(joined, kind="stable")
        self.owner = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)[order]
        self.values, self.cuts = np.unique(joined[order], return_index=True)
        self.cuts = np.append(self.cuts, len(joined))
        self.sizes, self.of, self.sets = sizes, np.array(self.of), []

    def meet(self, doc, component, items: np.ndarray) -> list:
        """A partner for each group of documents that one of the other side connects with."""
        if not self.docs:
            return []
        if self.values is None:
            self._build()
        mine = self._group(component)
        if (self.of == mine).all():
            return []
        at = np.minimum(np.searchsorted(self.values, items), len(self.values) - 1)
        at = at[self.values[at] == items]
        found = []
        if len(at):
            common = np.bincount(np.concatenate([self.owner[a:b] for a, b in zip(self.cuts[at].tolist(), self.cuts[at + 1].tolist())]), minlength=len(self.docs))
            for other in np.flatnonzero((100 * common >= self.percent * (self.sizes + len(items) - common)) & (self.of != mine)).tolist():
                group = int(self.of[other])
                if group != mine:
                    self.joined[group] = mine
                    self.of[self.of == group] = mine
                    found.append(self.docs[other])
        return found


def _block_links(placed: DataFrame, percent: int) -> DataFrame:
    """Verified links of rows (pair, side, component, doc_id, items) that come sorted."""
    kind = placed.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, block = None, _Block(percent)
        for batch in batches:
            left, right = [], []
            columns = [batch.column(name) for name in ("pair", "side", "component", "doc_id", "items")]
            for i in range(batch.num_rows):
                pair, side, component, doc, items = (col[i].as_py() for col in columns)
                if at != pair:
                    at, block = pair, _Block(percent)
                if side == 0:
                    block.add(doc, component, unpack(items))
                    continue
                for other in block.meet(doc, component, unpack(items)):
                    left.append(min(doc, other))
                    right.append(max(doc, other))
            yield pa.RecordBatch.from_arrays([pa.array(left, batch.schema.field("doc_id").type), pa.array(right, batch.schema.field("doc_id").type)], ["a", "b"])

    return placed.select("pair", "side", "component", "doc_id", "items").mapInArrow(work, f"a {kind}, b {kind}")


def _meet(texts: DataFrame, k: int, percent: int, sides: DataFrame, meetings: int, name: str) -> DataFrame:
    """Verified links of rows (pair, side, component, doc_id, digest): in each pair, side 1 against side 0."""
    places = sides.groupBy("doc_id").agg(F.first("digest").alias("digest"), F.collect_list(F.struct("pair", "side", "component")).alias("places"))
    sets = _with_sets(texts.join(places, "doc_id"), k)
    placed = sets.select("doc_id", F.explode("places").alias("p"), "items").select("p.*", "doc_id", "items").repartition(max(1, meetings), "pair").sortWithinPartitions("pair", "side", "component", "doc_id")
    return materialize(_block_links(placed, percent), name)


def _labelled(members: DataFrame, found: DataFrame) -> DataFrame:
    """Members of large regions that are not one component, with their components."""
    known = members.join(found, members["doc_id"] == found["id"], "left").select("tree", "front", "piece", "doc_id", "digest", "n", F.coalesce("component", "doc_id").alias("component"))
    known = materialize(known, "large-labels")
    mixed = known.groupBy("tree", "front").agg(F.min("component").alias("least"), F.max("component").alias("most")).where("least <> most").select("tree", "front")
    regions = freeze(mixed.select(F.concat_ws(":", "tree", F.hex("front")).alias("__region")), "mixed-regions")  # fewer than pieces
    return known.join(regions.hinted(), F.concat_ws(":", "tree", F.hex("front")) == F.col("__region"), "left_semi")


def _finish(texts: DataFrame, k: int, percent: int, members: DataFrame, links: DataFrame) -> DataFrame:
    """Components of ``links`` and of all links inside the large regions; ``members`` has tree, front, piece, doc_id, digest, n."""
    found = components(links)
    # regions take turns by tree, because the trees' regions hold much the same documents: what one tree connects, the next need not compare
    for (tree,) in sorted(members.select("tree").distinct().collect()):  # the trees at most
        unlike = materialize(_labelled(members.where(F.col("tree") == tree), found), "unlike")
        if unlike.limit(1).count() == 0:
            continue
        # the longest document of each component, the longest ones of a region
        longest = unlike.groupBy("front", "component").agg(F.max(F.struct("n", "doc_id")).alias("top"))
        rank = F.row_number().over(Window.partitionBy("front").orderBy(F.col("top.n").desc(), "top.doc_id"))
        pivots = materialize(longest.withColumn("r", rank).where(F.col("r") <= PIVOTS).select("front", F.col("top.doc_id").alias("doc_id")), "pivots")
        pieces = unlike.select("front", "piece").distinct().withColumn("pair", F.concat_ws(":", F.hex("front"), "piece"))
        of_pivots = unlike.join(pivots, ["front", "doc_id"]).select("front", "doc_id", "digest", "component").join(pieces, "front").select("pair", F.lit(0).alias("side"), "component", "doc_id", "digest")
        rest = unlike.select(F.concat_ws(":", F.hex("front"), "piece").alias("pair"), F.lit(1).alias("side"), "component", "doc_id", "digest")
        more = _meet(texts, k, percent, of_pivots.unionByName(rest), pieces.count(), "pivot-links")
        if more.limit(1).count():
            links = links.unionByName(more)
            found = components(links)
            unlike = materialize(_labelled(members.where(F.col("tree") == tree), found), "unlike")
        rows = unlike.count()
        if rows == 0:
            continue
        ranged = materialize(unlike.repartitionByRange(parts_for(rows, REGION_ROWS), "front", "component", "doc_id").withColumn("part", F.spark_partition_id()), "large-ranges")
        before = Window.partitionBy("part", "front").orderBy("component", "doc_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        blocks = materialize(ranged.withColumn("sub", F.floor((F.sum("n").over(before) - F.col("n")) / REGION_ITEMS)).withColumn("block", F.struct("part", "sub")), "blocks")
        each = materialize(blocks.groupBy("front", "block").agg(F.min("component").alias("least"), F.max("component").alias("most")), "block-list")
        a, b = each.alias("a"), each.alias("b")
        pairs = a.join(b, (F.col("a.front") == F.col("b.front")) & (F.col("a.block") <= F.col("b.block")) & (F.least("a.least", "b.least") != F.greatest("a.most", "b.most")))
        pairs = materialize(pairs.select("a.front", F.col("a.block").alias("x"), F.col("b.block").alias("y"), F.monotonically_increasing_id().cast("string").alias("pair")), "block-pairs")
        sides = pairs.select("front", "pair", F.posexplode(F.array("x", "y")).alias("side", "block"))
        more = _meet(texts, k, percent, blocks.join(sides, ["front", "block"]).select("pair", "side", "component", "doc_id", "digest"), pairs.count(), "block-links")
        if more.limit(1).count():
            links = links.unionByName(more)
            found = components(links)
    return found


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every id in ``links`` (a, b): the smallest id reachable. ``links`` is read many times.

    Each round takes the smallest label among an id and its neighbours and then the label of that label, until nothing changes.
    """
    both = materialize(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    labels = materialize(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("c")).select(F.col("a").alias("id"), "c"), "labels")
    while True:
        near = both.join(labels, both["b"] == labels["id"]).groupBy("a").agg(F.min("c").alias("n"))
        lower = labels.join(near, labels["id"] == near["a"]).select("id", F.col("c").alias("old"), F.least("c", "n").alias("c"))
        lower = materialize(lower, "labels")
        jump = lower.select(F.col("id").alias("j"), F.col("c").alias("jc"))
        after = materialize(lower.join(jump, F.col("c") == F.col("j")).select("id", "old", F.least("c", "jc").alias("c")), "labels")
        labels = after.select("id", "c")
        if after.where("c <> old").limit(1).count() == 0:
            return labels.select("id", F.col("c").alias("component"))


def repeated_ids(rows: DataFrame, id_col: str = "doc_id") -> bool:
    """Is any id there more than once?"""
    return rows.where(F.col(id_col).isNotNull()).groupBy(id_col).count().where("count > 1").limit(1).count() > 0


def _class_name(kind: T.DataType, repeated: bool) -> Column:
    """What a class is known by: its smallest id, or, where ids repeat, text that sorts by that id and has the digest after it."""
    if not repeated:
        return F.col("rep")
    rep = F.col("rep").cast("string")
    if isinstance(kind, T.IntegralType):
        rep = F.lpad((F.col("rep").cast("decimal(20,0)") + F.lit(Decimal(2**63))).cast("decimal(21,0)").cast("string"), 21, "0")
    return F.concat_ws(":", rep, F.hex("digest"))


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept."""
    return _classified(docs, k, percent, id_col, text_col).select("doc_id", "n_shingles", "component_id", "kept")


def _classified(docs: DataFrame, k: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """doc_id, mark, n_shingles, digest, component_id, kept, and stays: is the row's class the one that stands for its component?"""
    rows = narrow(docs, id_col, text_col)
    repeated = repeated_ids(rows)
    marked = materialize(_signatures(rows.withColumn("mark", F.md5("text") if repeated else F.lit(None).cast("string")), k), "signatures")
    classes = marked.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("rep"), F.max("signature").alias("signature"), F.max("n_shingles").alias("n"))
    classes = materialize(classes.withColumn("name", _class_name(marked.schema["doc_id"].dataType, repeated)), "classes")
    # trees: the signature read from another place, around its end
    twice = F.concat("signature", "signature")
    trees = F.array(*[F.substring(twice, 4 * VALUES_PER_TREE * t + 1, 4 * DEPTH) for t in range(TREES)])
    forest = classes.select("name", "n", F.posexplode(trees).alias("tree", "key")).withColumn("front", F.substring("key", 1, 4 * SHARED))
    regions = forest.groupBy("tree", "front").agg(F.count("*").alias("rows"), F.sum("n").alias("items")).where("rows > 1")
    is_large = (F.col("rows") > REGION_ROWS) | (F.col("items") > REGION_ITEMS)
    shared = materialize(forest.join(regions, ["tree", "front"]).select("tree", "front", "key", "name", "n", is_large.alias("is_large")), "regions")
    counts = {r["is_large"]: r["count"] for r in shared.groupBy("is_large").count().collect()}  # two rows
    parts, ranges = parts_for(counts.get(False, 0), REGION_ROWS), parts_for(counts.get(True, 0), REGION_ROWS)
    whole = shared.where(~F.col("is_large")).withColumn("piece", F.concat(F.lit("w"), F.pmod(F.xxhash64("tree", "front"), F.lit(parts)).cast("string")))
    # pieces of large regions: ranges of the sorted order, and in them runs of REGION_ITEMS shingles
    cut = shared.where("is_large").repartitionByRange(ranges, "tree", "key", "name").withColumn("part", F.spark_partition_id())
    before = Window.partitionBy("part", "tree", "front").orderBy("key", "name").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = F.floor((F.sum("n").over(before) - F.col("n")) / REGION_ITEMS).cast("string")
    cut = materialize(cut, "cut-regions").withColumn("piece", F.concat_ws(":", F.lit("c"), "part", run)).drop("part")
    placed = materialize(whole.unionByName(cut), "pieces")
    digests = classes.select("name", "rep", (F.col("digest") if repeated else F.lit(None).cast("binary")).alias("digest"))
    texts = rows.select("doc_id", "text")
    if repeated:  # the texts of a class's id go on under its name; those of another class are told apart by their digests
        texts = materialize(texts.distinct().join(digests, texts["doc_id"] == F.col("rep")).select(F.col("name").alias("doc_id"), "text"), "texts")
    places = placed.groupBy("name").agg(F.collect_list(F.struct("piece", "tree", "key")).alias("places"))  # one place a tree at most
    wanted = places.join(digests, "name").select(F.col("name").alias("doc_id"), "digest", "places")
    sets = _with_sets(texts.join(wanted, "doc_id"), k)
    sorted_sets = sets.select("doc_id", F.explode("places").alias("p"), "items").select("p.*", "doc_id", "items").repartition(parts + ranges, "piece").sortWithinPartitions("piece", "tree", "key", "doc_id")
    links = materialize(_links(sorted_sets, percent), "pairs")
    members = placed.where("is_large").join(digests, "name").select("tree", "front", "piece", F.col("name").alias("doc_id"), "digest", "n")
    found = _finish(texts, k, percent, members, links)
    component = F.coalesce("component", "name")
    by_class = classes.join(found, classes["name"] == found["id"], "left").select(F.col("digest").alias("class"), "rep", component.alias("component"), (component == F.col("name")).alias("first"))
    if repeated:
        by_class = by_class.withColumnRenamed("rep", "own_rep").join(classes.select(F.col("name").alias("component"), "rep"), "component").select("class", F.col("own_rep").alias("rep"), F.col("rep").alias("component"), "first")
    out = marked.join(by_class, marked["digest"] == by_class["class"], "left")
    component = F.coalesce("component", "doc_id")
    stays = F.when(F.col("class").isNull(), True).otherwise(F.col("first") & F.col("doc_id").eqNullSafe(F.col("rep")))
    return out.select("doc_id", "mark", "n_shingles", "digest", component.alias("component_id"), component.eqNullSafe(F.col("doc_id")).alias("kept"), stays.alias("stays"))


def drop_near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay (the smallest id of each component), with their columns; of repeated rows one stays."""
    classified = _classified(docs, k, percent, id_col, text_col).where("stays")
    if not repeated_ids(docs, id_col):
        return docs.join(classified.select(F.col("doc_id").alias("__id")), docs[id_col].eqNullSafe(F.col("__id")), "left_semi")
    # of an id's texts, those whose class stands for its component, one of each class
    kept = classified.groupBy(F.col("doc_id").alias("__id"), F.coalesce(F.hex("digest"), "mark").alias("__class")).agg(F.min("mark").alias("__mark"))
    tagged = docs.withColumn("__text", F.md5(F.coalesce(c(text_col).cast("string"), F.lit(""))))
    stay = tagged.join(kept, tagged[id_col].eqNullSafe(F.col("__id")) & (F.col("__text") == F.col("__mark")), "left_semi")
    return stay.dropDuplicates([id_col, "__text"]).drop("__text")
