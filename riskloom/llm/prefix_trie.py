"""The prefix trie of conversations, built as a burst trie.

A turn is its digest of role and text. Conversations become strings of turn digests, cut into segments of ``SEGMENT`` turns, so that no row follows the
length of a conversation; each segment is a suffix that lies in the container of its trie head (the turns before it). Equal
strings of a container are one string that carries the number of its conversations, so copies cost nothing further. A container of more than ``CONTAINER_BYTES`` is
burst: what all its strings share becomes a chain of nodes, and the strings go on to new containers by their next turn digest. This is repeated until
every container is small; then each is sorted and swept once, a stack of open nodes giving the nodes below its head.

The trie is swept twice: the first time gives members and children of each node; then every node's own saving and every leaf is credited to the
smallest member of its node, and the second sweep adds these up over the members. No step follows the depth of the trie.

Defined results: rows without a conversation id take no part; a null role or text is empty; rows of one conversation and turn are
ordered by the digest of role and text, and a repeated row is one more turn; a null turn comes first; no conversations give no nodes (not even
the root); other columns are ignored. A conversation has fewer than 2^31 turns.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.exprs import c
from riskloom.functions.joins import freeze
from riskloom.llm.common import parts_for, running_by_key, ship_package, word_count
from riskloom.session import materialize

SEGMENT = 256  # turns
CONTAINER_BYTES = 1 << 20
ROWS_PER_RANGE = 100_000
UNIT = 20  # bytes of a turn in a string: its digest and its words
SUMS = ("n", "leaves", "saved")
_NODE = "conv_id long, depth long, parent_conv_id long, words long, end_conv long, n long, leaves long, saved long"


@dataclass(frozen=True)
class Trie:
    """``nodes``: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, end_conv (smallest of the members that end
    there). ``members``: conv_id, end_conv; the conversations that end in the same node share it."""

    nodes: DataFrame = field(repr=False)
    members: DataFrame = field(repr=False)


def numbered_turns(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, place (from 1), digest (hex), words: the turns of each conversation in order."""
    role, text = (F.coalesce(c(n).cast("string"), F.lit("")) for n in (role_col, text_col))
    digest = F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text))
    rows = conversations.where(c(conv_col).isNotNull()).select(
        c(conv_col).cast("bigint").alias("conv_id"), c(turn_col).cast("bigint").alias("turn"), digest.alias("digest"), word_count(text).alias("words"), F.lit(1).cast("bigint").alias("place"))
    rows = materialize(rows, "turns")
    placed = running_by_key(rows, "conv_id", [F.col("turn").asc_nulls_first(), F.col("digest")], ["place"], parts_for(rows.count(), ROWS_PER_RANGE), "turns-in-order")
    return placed.select("conv_id", F.col("place_upto").alias("place"), "digest", "words")


def shared_openings(turns: DataFrame, block: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations that take their first turns from the first conversation of their block of ids.

    Conversation c starts with the first h turns of conversation c - c % block (all if it has fewer, none if it is absent) and goes on with its own turns after
    its first h; h = crc32(c as text) % most. Returns the rows (conv_id, place, digest, words) and every conversation (conv_id, length).
    """
    turns = materialize(turns, "numbered-turns")
    opening = F.crc32(F.col("conv_id").cast("string")) % most
    first = (F.col("conv_id") - F.col("conv_id") % block).alias("first")
    convs = turns.groupBy("conv_id").agg(F.max("place").alias("own")).select("conv_id", "own", opening.alias("h"), first)
    lengths = convs.where(F.col("conv_id") == F.col("first")).select(F.col("conv_id").alias("first"), F.col("own").alias("theirs"))
    given = F.least(F.col("h"), F.coalesce(F.col("theirs"), F.lit(0)))
    convs = materialize(convs.join(lengths, "first", "left").select("conv_id", "first", "h", given.alias("given"), (given + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("length")), "conversations")
    heads = turns.where((F.col("conv_id") % block == 0) & (F.col("place") < most)).withColumnRenamed("conv_id", "first")
    taken = convs.join(heads, "first").where(F.col("place") <= F.col("h")).select("conv_id", "place", "digest", "words")
    # few conversations get fewer turns than they give up
    fewer = freeze(convs.where("given < h").select(F.col("conv_id").alias("__c"), (F.col("h") - F.col("given")).alias("__less")), "short-openings")
    rest = fewer.attach(turns.where(F.col("place") > opening), F.col("conv_id"), "__c")
    rest = rest.select("conv_id", (F.col("place") - F.coalesce(F.col("__less"), F.lit(0))).alias("place"), "digest", "words")
    return taken.unionByName(rest), convs.select("conv_id", "length")


def _segments(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """conv_id, level, seg (packed turns), x, y (hashes), box (the container of the head), ends (is the last turn in it?).

    A conversation that ends where a segment does has an empty string in the next level too, so that a head's members are the strings of its container.
    """
    unit = F.concat("digest", F.lpad(F.hex("words"), 8, "0"))
    level = F.floor((F.col("place") - 1) / SEGMENT).cast("bigint").alias("level")
    packed = F.unhex(F.array_join(F.transform(F.array_sort(F.collect_list("u")), lambda u: u["unit"]), ""))  # SEGMENT turns at most
    full = turns.select("conv_id", level, F.struct("place", unit.alias("unit")).alias("u")).groupBy("conv_id", "level").agg(packed.alias("seg"))
    at_border = convs.where(F.col("length") % SEGMENT == 0)
    empty = at_border.select("conv_id", (F.col("length") / SEGMENT).cast("bigint").alias("level"), F.unhex(F.lit("")).alias("seg"))
    border = freeze(at_border.select(F.col("conv_id").alias("__c"), (F.col("length") / SEGMENT).cast("bigint").alias("__last")), "border-conversations")
    rows = border.attach(full.unionByName(empty), F.col("conv_id"), "__c")
    size = F.octet_length("seg")
    ends = F.when((size > 0) & (size < UNIT * SEGMENT), True).when(size > 0, F.coalesce(F.col("level") == F.col("__last") - 1, F.lit(False))).otherwise(F.col("level") == 0)
    rows = materialize(rows.select("conv_id", "level", "seg", ends.alias("ends"), F.xxhash64("level", "seg").alias("x"), F.xxhash64("seg", F.lit("second"), "level").alias("y")), "segments")
    root = F.md5(F.lit("root"))
    late = rows.where("level > 0").select("conv_id").distinct()
    n_late = rows.where("level > 0").count()
    if n_late == 0:
        return rows.withColumn("box", root)
    chains = running_by_key(rows.join(late, "conv_id", "left_semi"), "conv_id", [F.col("level")], ["x", "y"], parts_for(2 * n_late, ROWS_PER_RANGE), "segment-chains", xor=True)
    head = F.md5(F.concat_ws(":", "level", F.col("x_upto").bitwiseXOR(F.col("x")), F.col("y_upto").bitwiseXOR(F.col("y"))))
    later = chains.where("level > 0").select(*rows.columns, head.alias("box"))
    return materialize(rows.where("level = 0").withColumn("box", root).unionByName(later), "segments-under-heads")


def _prefix(units: int | Column) -> Column:
    return F.lit(UNIT) * units


def _words(unit: Column) -> Column:
    return F.conv(F.hex(F.substring(unit, 17, 4)), 16, 10).cast("bigint")


def _burst(rows: DataFrame) -> tuple[DataFrame | None, DataFrame]:
    """Nodes of the containers that were burst, and the strings of all small containers."""
    kept, nodes = [], []
    names = rows.columns
    while True:
        sizes = rows.groupBy("box").agg(F.count("*").alias("strings"), F.sum(F.octet_length("seg").cast("bigint")).alias("bytes"), F.min("conv_id").alias("__least"), *[F.sum(s).alias(f"__{s}") for s in SUMS])
        large = freeze(sizes.where((F.col("strings") > 1) & (F.col("bytes") > CONTAINER_BYTES)).withColumnRenamed("box", "__box").drop("strings", "bytes"), "large-containers")
        if large.df.limit(1).count() == 0:
            kept.append(rows)
            break
        tagged = large.attach(rows, F.col("box"), "__box")
        kept.append(tagged.where(F.col("__least").isNull()).select(*names))
        inside = tagged.where(F.col("__least").isNotNull())
        ends = inside.groupBy("box").agg(F.min(F.struct("seg", "end_conv")).alias("lo"), F.max("seg").alias("hi"), *[F.first(n).alias(n) for n in ("depth", "parent_conv_id", "words", "own", "__least", *[f"__{s}" for s in SUMS])])
        short = (F.least(F.octet_length("lo.seg"), F.octet_length("hi")) / UNIT).cast("int")
        common = F.filter(F.sequence(F.lit(1), F.greatest(short, F.lit(1))), lambda i: F.substring(F.col("lo.seg"), F.lit(1), _prefix(i)) == F.substring(F.col("hi"), F.lit(1), _prefix(i)))
        burst = freeze(ends.withColumn("shared", F.when(short > 0, F.size(common)).otherwise(0)), "burst-containers")
        values = [F.col(f"__{s}").alias(s) for s in SUMS]
        whole = F.octet_length("lo.seg") == _prefix(F.col("shared"))
        head = burst.df.where("own").select(F.col("__least").alias("conv_id"), "depth", "parent_conv_id", "words", F.when(F.octet_length("lo.seg") == 0, F.col("lo.end_conv")).alias("end_conv"), *values)
        chain = burst.df.where("shared > 0").select("*", F.explode(F.sequence(F.lit(1), F.col("shared"))).alias("i")).select(
            F.col("__least").alias("conv_id"), (F.col("depth") + F.col("i")).alias("depth"), F.col("__least").alias("parent_conv_id"),
            _words(F.substring(F.col("lo.seg"), _prefix(F.col("i") - 1) + 1, F.lit(UNIT))).alias("words"), F.when((F.col("i") == F.col("shared")) & whole, F.col("lo.end_conv")).alias("end_conv"), *values)
        nodes += [head, chain]
        lengths = burst.select(F.col("box").alias("__box"), F.col("shared").alias("__shared"))
        split = lengths.attach(inside, F.col("box"), "__box").where(F.octet_length("seg") > _prefix(F.col("__shared")))
        unit = F.substring(F.col("seg"), _prefix(F.col("__shared")) + 1, F.lit(UNIT))
        rows = split.select(
            F.md5(F.concat("box", F.hex(unit))).alias("box"), (F.col("depth") + F.col("__shared") + 1).alias("depth"), F.col("__least").alias("parent_conv_id"), _words(unit).alias("words"), F.lit(True).alias("own"),
            F.substring(F.col("seg"), _prefix(F.col("__shared") + 1) + 1, F.octet_length("seg")).alias("seg"), "conv_id", "end_conv", *SUMS)
        rows = materialize(rows.select(*names), "burst-strings")
    small = kept[0]
    for more in kept[1:]:
        small = small.unionByName(more)
    if not nodes:
        return None, small
    found = nodes[0]
    for more in nodes[1:]:
        found = found.unionByName(more)
    return found, small


def sweep(strings: list[tuple], depth: int, own: bool, parent: int | None, words: int) -> Iterator[tuple]:
    """Nodes of one container from its sorted strings (seg, conv_id, end_conv, sums...): a stack of open nodes along the last string.

    A node: conv_id, depth, parent_conv_id, words, end_conv, sums.
    """
    width = len(strings[0]) - 3
    nodes: list[list] = [[-1, depth, words, None, None, *[0] * width]]  # parent, depth, words, end, least, sums
    stack, last = [0], b""

    def close(level: int) -> None:
        while len(stack) > level:
            node = nodes[stack.pop()]
            up = nodes[node[0]]
            up[4] = node[4] if up[4] is None or node[4] < up[4] else up[4]
            for i in range(5, 5 + width):
                up[i] += node[i]

    for seg, conv, end, *sums in strings:
        shared, most = 0, min(len(seg), len(last))
        while shared < most and seg[shared:shared + UNIT] == last[shared:shared + UNIT]:
            shared += UNIT
        close(shared // UNIT + 1)
        for at in range(shared, len(seg), UNIT):
            nodes.append([stack[-1], depth + at // UNIT + 1, int.from_bytes(seg[at + 16:at + UNIT], "big"), None, None, *[0] * width])
            stack.append(len(nodes) - 1)
        node = nodes[stack[-1]]
        node[3] = end
        node[4] = conv if node[4] is None or conv < node[4] else node[4]
        for i, v in enumerate(sums, 5):
            node[i] += v
        last = seg
    close(1)
    for i, node in enumerate(nodes):
        if i or own:
            yield node[4], node[1], nodes[node[0]][4] if i else parent, node[2], node[3], *node[5:]


def _swept(strings: DataFrame) -> DataFrame:
    """Nodes of all small containers: each in one task, sorted by the shuffle."""
    names = ["box", "depth", "own", "parent_conv_id", "words", "seg", "conv_id", "end_conv", *SUMS]
    kinds = pa.schema([(part.split()[0], pa.int64()) for part in _NODE.split(", ")])

    def out(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(col, pa.int64()) for col in zip(*rows)], schema=kinds)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        box, head, held, ready = None, (), [], []
        for batch in batches:
            for b, depth, own, parent, words, *string in zip(*[batch.column(n).to_pylist() for n in names]):
                if b != box:
                    if held:
                        ready += sweep(held, *head)
                    box, head, held = b, (depth, own, parent, words), []
                    if len(ready) > 20_000:
                        yield out(ready)
                        ready = []
                held.append(tuple(string))
        if held:
            ready += sweep(held, *head)
        if ready:
            yield out(ready)

    return strings.select(*names).repartition("box").sortWithinPartitions("box", "seg").mapInArrow(work, _NODE)


def _nodes(segments: DataFrame, credits: DataFrame | None, name: str) -> DataFrame:
    """All nodes; ``credits`` (conv_id, leaves, saved) are added up over the members of each node."""
    rows = segments.withColumns({"leaves": F.lit(0), "saved": F.lit(0)}) if credits is None else segments.join(credits, "conv_id", "left")
    own = F.col("level") == 0  # the root; other heads are nodes of the level before
    strings = rows.groupBy("box", "level", "seg").agg(
        F.min(F.when(F.col("ends"), F.col("conv_id"))).alias("end_conv"), F.count("*").alias("n"), F.min("conv_id").alias("least"),
        *[F.sum(F.coalesce(F.col(s), F.lit(0)).cast("bigint")).alias(s) for s in SUMS[1:]])
    strings = strings.select("box", (F.col("level") * SEGMENT).alias("depth"), F.lit(None).cast("bigint").alias("parent_conv_id"), F.lit(0).cast("bigint").alias("words"), own.alias("own"), "seg",
                             F.col("least").alias("conv_id"), "end_conv", *SUMS)
    burst, small = _burst(materialize(strings, f"{name}-strings"))
    swept = _swept(small)
    return materialize(swept if burst is None else swept.unionByName(burst.select(*swept.columns)), f"{name}-nodes")


def prefix_trie(turns: DataFrame, convs: DataFrame) -> Trie:
    """The trie of the rows (conv_id, place, digest, words) of the conversations (conv_id, length)."""
    ship_package(turns.sparkSession)
    segments = _segments(turns, convs)
    first = _nodes(segments, None, "first")
    children = first.where(F.col("parent_conv_id").isNotNull()).groupBy(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(F.count("*").alias("n_children"))
    shape = materialize(first.join(children, ["conv_id", "depth"], "left").select(
        "conv_id", "depth", F.coalesce("n_children", F.lit(0)).alias("n_children"), ((F.col("n") - 1) * F.col("words")).alias("own_saved")), "shape")
    credits = materialize(shape.groupBy("conv_id").agg(F.max((F.col("n_children") == 0).cast("int")).alias("leaves"), F.sum("own_saved").alias("saved")), "credits")
    second = _nodes(segments, credits, "second")
    # the smallest member's credit holds the savings of the nodes above too: take them off
    above = running_by_key(shape, "conv_id", [F.col("depth")], ["own_saved"], parts_for(shape.count(), ROWS_PER_RANGE), "savings-above")
    nodes = second.join(above.drop("n_children"), ["conv_id", "depth"]).join(shape.select("conv_id", "depth", "n_children"), ["conv_id", "depth"]).select(
        "conv_id", "depth", "parent_conv_id", F.col("n").alias("n_convs"), "n_children", F.col("leaves").alias("n_leaves"),
        (F.col("saved") - F.col("own_saved_upto") + F.col("own_saved")).alias("saved_tokens"), "end_conv")
    whole = segments.groupBy("conv_id").agg(F.max("level").alias("level"), F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"))
    same = whole.groupBy("level", "x", "y").agg(F.min("conv_id").alias("end_conv"), F.count("*").alias("copies"))
    copied = freeze(same.where("copies > 1").select(F.concat_ws(":", "level", "x", "y").alias("__key"), "end_conv"), "copied-conversations")
    members = copied.attach(whole, F.concat_ws(":", "level", "x", "y"), "__key").select("conv_id", F.coalesce("end_conv", "conv_id").alias("end_conv"))
    return Trie(nodes, members)


def joined_ids(members: DataFrame) -> DataFrame:
    """end_conv, ends_sha256: hex SHA-256 of the ascending member ids, comma-joined; ids stream through the hash, so memory does not follow a group."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state, done = None, None, []
        for batch in batches:
            for end, conv in zip(batch.column("end_conv").to_pylist(), batch.column("conv_id").to_pylist()):
                if end != at:
                    if state is not None:
                        done.append((at, state.hexdigest()))
                    at, state = end, hashlib.sha256(str(conv).encode())
                else:
                    state.update(f",{conv}".encode())
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.int64()), pa.array([d[1] for d in done], pa.string())], ["end_conv", "ends_sha256"])
            done = []
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([state.hexdigest()], pa.string())], ["end_conv", "ends_sha256"])

    ship_package(members.sparkSession)
    return members.select("end_conv", "conv_id").repartition("end_conv").sortWithinPartitions("end_conv", "conv_id").mapInArrow(work, "end_conv long, ends_sha256 string")


def trie_digest(trie: Trie) -> DataFrame:
    """The nodes with a hash over the ids of the conversations that end there."""
    hashes = joined_ids(trie.members)
    return trie.nodes.join(hashes, "end_conv", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))
