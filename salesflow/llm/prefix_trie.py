"""The prefix trie of conversations, peeled from its greatest depth.

An entry is a sequence of turns with what was found below it. At depth d the
conversations that end there meet the entries whose turns beyond d are already
stripped; equal sequences are grouped, each group is a node, and its last turn
is stripped. A node is thus found and its subtree summed in the same pass.

Depths are cut into bands, 1 to 8, 9 to 16, 17 to 32 and so on, so that an
entry carries the turns of one band only. The key of a sequence is the digest of the
band's first key and of the turns in the band. Where one entry alone has a
band's first key, nothing in the band can meet it: all its turns there are
stripped at once. Other entries are stripped turn by turn.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesflow.llm.lookups import lookup
from salesflow.operators.ordered import number_rows
from salesflow.session import stage

#: Depths at which bands begin; after the last, bands are as wide as the last one.
STARTS = [0, 8, 16, 32, 64, 128, 256, 512]
WIDEST = 512
#: Conversations that lend their first turns, and the most turns lent; see ``rebuilt``.
LENDERS, LENT = 100, 6
#: Ids of conversations joined into one text before a node's texts are hashed.
SPAN = 4096

ROOT = b"\0" * 16
_SUMS = ["n", "kids", "leaves", "saved"]


def turns_of(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, place, body, chars) of each turn and (conv_id, size) of each conversation.

    Places count from 1 in the order of (turn, role, text), nulls first. All
    rows are numbered together over ranges of that order, so a conversation
    that holds much of the table is spread over many tasks.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = df.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        role.alias("role"),
        text.alias("text"),
        F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)).alias("body"),
        F.length(text).cast("long").alias("chars"),
    )
    numbered = stage(number_rows(rows, ["conv_id", "turn", "role", "text"], keep=["conv_id", "body", "chars"]), "numbered-turns")
    sizes = numbered.groupBy("conv_id").agg(F.min("row_number").alias("first"), F.count(F.lit(1)).alias("size"))
    sizes = stage(sizes, "conversations")
    placed = lookup(numbered, sizes, ["conv_id"], "size", numbered.count())
    placed = placed.select("conv_id", (F.col("row_number") - F.col("first") + 1).alias("place"), "body", "chars")
    return stage(placed, "turns"), sizes.select("conv_id", "size")


def rebuilt(turns: DataFrame, sizes: DataFrame, lenders: int = LENDERS, lent: int = LENT) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin with the first turns of another, as branches of a dialogue do.

    Conversation c takes the first h = crc32(c) % ``lent`` turns of
    conversation c - c % ``lenders`` (those it has), then its own after its
    first h. Returns (conv_id, depth, body, chars, size) of all turns, and
    (conv_id, size) of all conversations.
    """
    rule = sizes.select(
        "conv_id",
        F.col("size").alias("own"),
        (F.crc32(F.col("conv_id").cast("string").cast("binary")) % lent).alias("h"),
        (F.col("conv_id") - F.col("conv_id") % lenders).alias("lender"),
    )
    lenders_only = F.col("conv_id") % lenders == 0
    has = sizes.where(lenders_only).select(F.col("conv_id").alias("lender"), F.col("size").alias("has"))
    rule = rule.join(has, "lender", "left").withColumn("taken", F.least("h", F.coalesce("has", F.lit(0))))
    rule = stage(rule.withColumn("size", F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).drop("has"), "rules")
    heads = turns.where(lenders_only & (F.col("place") < lent)).withColumnRenamed("conv_id", "lender")
    first = rule.join(heads, "lender").where("place <= h").withColumn("depth", F.col("place"))
    rest = lookup(turns, rule.drop("lender"), ["conv_id"], "own", turns.count()).where("place > h")
    rest = rest.withColumn("depth", F.col("taken") + F.col("place") - F.col("h"))
    columns = ["conv_id", "depth", "body", "chars", "size"]
    return first.select(columns).unionAll(rest.select(columns)), rule.select("conv_id", "size")


def _start(depth: Column) -> Column:
    """The depth after which a turn's band begins."""
    wide = F.floor((depth - 1) / F.lit(WIDEST)) * WIDEST
    return F.greatest(*[F.when(depth > s, F.lit(s)) for s in STARTS], F.when(depth > 2 * WIDEST, wide)).cast("long")


def _key(before: bytes, turns: bytes) -> bytes:
    return hashlib.sha256(before + turns).digest()[:16]


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first key of each band; a conversation's bands come one after the other."""
    conversation, key = None, ROOT
    for batch in batches:
        before = []
        for conv, turns in zip(batch.column("conv_id").to_pylist(), batch.column("turns").to_pylist()):
            if conv != conversation:
                conversation, key = conv, ROOT
            before.append(key)
            key = _key(key, turns)
        yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("start"), pa.array(before, pa.binary())], names=["conv_id", "start", "before"])


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The keys of a band's depths and the running sum of its texts' lengths, which starts with 0."""
    for whole in batches:
        for at in range(0, whole.num_rows, WIDEST):
            batch, keys, upto = whole.slice(at, WIDEST), [], []
            for before, turns in zip(batch.column("before").to_pylist(), batch.column("turns")):
                hashed, own, sums = hashlib.sha256(), [], [0]
                for body, chars in zip(turns.values.field("body").to_pylist(), turns.values.field("chars").to_pylist()):
                    hashed.update(body)
                    own.append(_key(before, hashed.digest()))
                    sums.append(sums[-1] + chars)
                keys.append(own)
                upto.append(sums)
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("conv_id", "start", "ends", "before")),
                    pa.array(keys, pa.list_(pa.binary())),
                    pa.array(upto, pa.list_(pa.int64())),
                ],
                names=["conv_id", "start", "ends", "before", "keys", "upto"],
            )


def _bands(turns: DataFrame) -> DataFrame:
    """(conv_id, start, ends, before, keys, upto): the turns of a conversation in each band."""
    rows = turns.withColumn("start", _start(F.col("depth")))
    bands = rows.groupBy("conv_id", "start").agg(
        F.sort_array(F.collect_list(F.struct("depth", "body", "chars"))).alias("turns"),  # at most ``WIDEST``
        (F.max("depth") == F.max("size")).alias("ends"),
    )
    bands = stage(bands, "bands")
    whole = F.unhex(F.sha2(F.aggregate("turns", F.lit(b""), lambda all, turn: F.concat(all, turn["body"])), 256))
    chain = bands.select("conv_id", "start", whole.alias("turns")).repartition("conv_id").sortWithinPartitions("conv_id", "start")
    before = chain.mapInArrow(_chained, "conv_id long, start long, before binary")
    schema = "conv_id long, start long, ends boolean, before binary, keys array<binary>, upto array<long>"
    return bands.join(before, ["conv_id", "start"]).select("conv_id", "start", "ends", "before", "turns").mapInArrow(_keyed, schema)


def _grouped(entries: DataFrame) -> DataFrame:
    """Entries of one ``key`` become one."""
    sums = [F.sum(c).alias(c) for c in _SUMS]
    path = F.any_value(F.struct("before", "keys", "upto")).alias("path")
    return entries.groupBy("key").agg(path, F.min("conv_id").alias("conv_id"), *sums).select("key", "path.*", "conv_id", *_SUMS)


def _chars(upto: Column, depth: Column) -> Column:
    return F.element_at(upto, (depth + 1).cast("int")) - F.element_at(upto, depth.cast("int"))


def _as_nodes(grouped: DataFrame, start: int, depth: int) -> DataFrame:
    """Grouped entries of ``depth`` turns in their band, as nodes; they keep what an entry needs."""
    parent = F.element_at("keys", depth - 1) if depth > 1 else F.col("before")
    return grouped.select(
        "key",
        parent.alias("parent"),
        F.lit(start + depth).cast("long").alias("depth"),
        "conv_id",
        "n",
        "kids",
        F.when(F.col("kids") == 0, 1).otherwise(F.col("leaves")).cast("long").alias("leaves"),
        (F.col("saved") + (F.col("n") - 1) * _chars(F.col("upto"), F.lit(depth))).alias("saved"),
        "before",
        F.slice("keys", 1, depth - 1).alias("keys") if depth > 1 else F.array().cast("array<binary>").alias("keys"),
        F.slice("upto", 1, depth).alias("upto"),
    )


def _stripped(nodes: DataFrame) -> DataFrame:
    """Nodes without their last turn, as entries of one child."""
    return nodes.select("before", "keys", "upto", "conv_id", "n", F.lit(1).cast("long").alias("kids"), "leaves", "saved")


def _alone(entries: DataFrame, start: int) -> DataFrame:
    """The nodes of entries that nothing meets in their band, all depths at once."""
    size = F.size("keys")
    leaves = F.when(F.col("kids") == 0, 1).otherwise(F.col("leaves")).cast("long")
    each = entries.withColumns({"at": F.explode(F.sequence(F.lit(1), size)), "size": size, "of_all": leaves})
    above = F.when(F.col("at") > 1, F.element_at("keys", F.greatest(F.col("at") - 1, F.lit(1)))).otherwise(F.col("before"))
    below = F.element_at("upto", F.col("size") + 1) - F.element_at("upto", F.col("at"))
    return each.select(
        F.element_at("keys", F.col("at")).alias("key"),
        above.alias("parent"),
        (F.col("at") + start).cast("long").alias("depth"),
        "conv_id",
        "n",
        F.when(F.col("at") == F.col("size"), F.col("kids")).otherwise(1).cast("long").alias("kids"),
        F.col("of_all").alias("leaves"),
        (F.col("saved") + (F.col("n") - 1) * below).alias("saved"),
    )


def _last(keys: str = "keys") -> Column:
    return F.element_at(keys, -1)


def _peeled(bands: DataFrame) -> tuple[list[DataFrame], DataFrame | None]:
    """Written tables of all nodes but the root, and the depth-1 nodes as entries of the root."""
    found, survivors = [], None
    zero = F.lit(0).cast("long")
    columns = ["key", "parent", "depth", "conv_id", *_SUMS]
    for start in sorted((row["start"] for row in bands.select("start").distinct().collect()), reverse=True):
        band = bands.where(F.col("start") == start)
        entries = band.where("ends").select(
            _last().alias("key"), "before", "keys", "upto", "conv_id", F.lit(1).cast("long").alias("n"), *(zero.alias(c) for c in ("kids", "leaves", "saved"))
        )
        if survivors is not None:
            paths = band.where(~F.col("ends")).groupBy(_last().alias("key")).agg(F.any_value(F.struct("before", "keys", "upto")).alias("path"))
            entries = entries.unionByName(survivors.join(paths, "key").select("key", "path.*", "conv_id", *_SUMS))
        entries = stage(_grouped(entries), "entries")

        # an entry that no other shares the band's first key with; all begin at the root, so none there
        single = entries.groupBy("before").agg(F.count(F.lit(1)).alias("entries"), F.any_value(F.struct("key", "keys", "upto", "conv_id", *_SUMS)).alias("only"))
        single = stage(single.where(F.lit(start > 0) & (F.col("entries") == 1)).select("before", "only.*"), "single-entries")
        private = stage(_alone(single, start), "private-nodes")
        found.append(private)
        firsts = [private.where(F.col("depth") == start + 1)]
        shared = entries.join(single.select("key"), "key", "left_anti")
        deepest = shared.agg(F.max(F.size("keys"))).first()[0] or 0
        shared, nodes = stage(shared, "shared-entries") if deepest else shared, None
        for depth in range(deepest, 0, -1):
            level = shared.where(F.size("keys") == depth)
            if nodes is not None:
                level = level.unionByName(_stripped(nodes).withColumn("key", _last()))
            nodes = stage(_as_nodes(_grouped(level), start, depth), "nodes")
            found.append(nodes.select(columns))
        if nodes is not None:
            firsts.append(nodes.select(columns))
        strips = [f.select(F.col("parent").alias("key"), "conv_id", "n", F.lit(1).cast("long").alias("kids"), "leaves", "saved") for f in firsts]
        survivors = strips[0] if len(strips) == 1 else strips[0].unionAll(strips[1])
        sums = [F.sum(c).alias(c) for c in _SUMS]
        survivors = stage(survivors.groupBy("key").agg(F.min("conv_id").alias("conv_id"), *sums), "survivors")
    return found, survivors


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest for the texts of a key, which come one after the other; a text is dropped once hashed."""
    key, hashed = None, None

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([hashed.hexdigest()])], names=["key", "ends_sha256"])

    for batch in batches:
        for own, text in zip(batch.column("key").to_pylist(), batch.column("ids")):
            if own == key:
                hashed.update(b",")
            else:
                if key is not None:
                    yield row()
                key, hashed = own, hashlib.sha256()
            hashed.update(text.as_py().encode())
    if key is not None:
        yield row()


def _ends(ends: DataFrame) -> DataFrame:
    """(key, ends_sha256) from (key, conv_id): ids are joined by spans of ``SPAN``, and the spans hashed in order."""
    span = F.expr(f"conv_id div {SPAN} - if(conv_id % {SPAN} < 0, 1, 0)")  # rounded down
    ids = F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",")
    spans = ends.groupBy("key", span.alias("span")).agg(ids.alias("ids"))
    return spans.repartition("key").sortWithinPartitions("key", "span").mapInArrow(_hashed, "key binary, ends_sha256 string")


def trie(turns: DataFrame, sizes: DataFrame) -> DataFrame:
    """Every node of the trie of (conv_id, depth, body, chars, size) turns; ``sizes`` (conv_id, size) names all conversations.

    Depths of a conversation go from 1 to its size without gaps.
    """
    bands = stage(_bands(turns), "keyed-bands")
    found, survivors = _peeled(bands)
    empty = sizes.where("size = 0")
    root = empty.select("conv_id", F.lit(1).cast("long").alias("n"), *(F.lit(0).cast("long").alias(c) for c in ("kids", "leaves", "saved")))
    if survivors is not None:
        root = root.unionAll(survivors.select("conv_id", *_SUMS))
    root = root.agg(F.min("conv_id").alias("conv_id"), *[F.sum(c).alias(c) for c in _SUMS]).where("conv_id IS NOT NULL")
    root = root.select(
        F.lit(ROOT).alias("key"),
        F.lit(None).cast("binary").alias("parent"),
        F.lit(0).cast("long").alias("depth"),
        "conv_id",
        "n",
        "kids",
        F.when(F.col("kids") == 0, 1).otherwise(F.col("leaves")).cast("long").alias("leaves"),
        "saved",
    )
    nodes = root
    for table in found:
        nodes = nodes.unionByName(table)
    nodes = stage(nodes, "trie-nodes")
    ends = bands.where("ends").select(_last().alias("key"), "conv_id").unionAll(empty.select(F.lit(ROOT).alias("key"), "conv_id"))
    nodes = stage(nodes.join(_ends(ends), "key", "left"), "ended-nodes")

    parents = nodes.where("kids > 0").select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"), F.col("kids").alias("of_parent"))
    below = lookup(nodes.where("parent IS NOT NULL"), parents, ["parent"], "of_parent", nodes.count())
    columns = ["conv_id", "depth", "parent_conv_id", "n", "kids", "leaves", "saved", "ends_sha256"]
    whole = below.select(columns).unionAll(nodes.where("parent IS NULL").withColumn("parent_conv_id", F.lit(None).cast("long")).select(columns))
    return whole.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        F.col("n").alias("n_convs"),
        F.col("kids").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


def prefix_trie(df: DataFrame, lenders: int = LENDERS, lent: int = LENT) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 for every node.

    Conversations are rebuilt by ``rebuilt`` (with ``lent`` 1 they stay as
    they are); a node is a distinct sequence of first turns, the root the
    empty one. Null roles and texts are empty; turns are ordered by turn
    (nulls first), ties by role and text, and rows that repeat are turns each.
    Rows without a conv_id belong to no conversation and are left out. Texts
    of any length count by their digest and their code points. An empty table
    has no root, as no conversation is its member. Other columns are ignored,
    whatever their names.
    """
    turns, sizes = turns_of(df)
    return trie(*rebuilt(turns, sizes, lenders, lent))
