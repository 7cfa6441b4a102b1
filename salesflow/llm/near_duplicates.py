"""Near duplicates: MinHash bands name candidates, odd sketches sift them, full shingle sets decide.

A document's class is its set of shingles: documents with the same set are one
row from the first shuffle on. Candidates are found in rounds. Every band's
bucket gets a leader; each class is compared with the leader that its sketch
says is nearest, then with those still in other components. Last, pairs of the
same bucket that are in different components are compared. So a large group of
near copies costs a few comparisons for each member, while no pair of a bucket
whose link could join two components is left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesflow.llm.components import components
from salesflow.session import stage

#: Words of a shingle; similarity (in hundredths) from which documents are linked.
WORDS, PERCENT = 5, 75
#: MinHash bands and samples in each: a pair of similarity 0.75 shares no band with a chance of 5e-6.
BANDS, ROWS = 32, 4
#: Bins of a sketch's samples, as a power of two, and 64-bit words of its bitmap.
BINS, SKETCH = 11, 64
#: Shingles up to which a set is its own sample. The bits that differ are then never more than the shingles that
#: differ, so a pair with too many of them is surely no link, and nearly all that remain are links.
WHOLE = 1 << BINS
#: Pairs of larger sets whose sketches put them below this similarity (in hundredths) are not compared. At a similarity of
#: 0.75 the estimate has a standard deviation of at most 0.011, so this is over five of them away. In small
#: sets one shingle that takes another's bin counts for more, hence the samples that may lack besides.
FLOOR, SLACK = 69, 1.0
#: Words a worker remembers the hash of.
REMEMBERED = 500_000
#: Words shingled at once; a longer text is shingled in overlapping parts.
PART = 1 << 20

_MIX = np.uint64(0xFF51AFD7ED558CCD)
_HASHES: dict[bytes, int] = {}


def _generator() -> np.random.Generator:
    return np.random.Generator(np.random.PCG64(20))


_FACTORS = _generator().integers(1, 1 << 63, WORDS * 4 + BANDS * ROWS * 2, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(values: np.ndarray) -> np.ndarray:
    values = values ^ (values >> np.uint64(33))
    values = values * _MIX
    return values ^ (values >> np.uint64(29))


def _word_hashes(words: list[bytes]) -> np.ndarray:
    known = _HASHES
    if len(known) > REMEMBERED:
        known.clear()
    try:
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    except KeyError:
        for word in set(words).difference(known):
            known[word] = xxhash.xxh3_64_intdigest(word)
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def shingles(text: bytes, size: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles.

    Letters A-Z are lowered; words are parted by ASCII white space. A text with
    fewer than ``size`` words is one shingle, and one without words none.
    """
    words = text.lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    width, found = min(size, len(words)), []
    for at in range(0, len(words) - width + 1, PART):
        hashes = _word_hashes(words[at : at + PART + width - 1])
        total = np.full(len(hashes) - width + 1, width, dtype=np.uint64)
        for place in range(width):
            total = _mixed(total + hashes[place : len(hashes) - width + 1 + place] * _FACTORS[place])
        found.append(np.unique(total))
    return found[0] if len(found) == 1 else np.unique(np.concatenate(found))


def minhash(hashes: np.ndarray) -> np.ndarray:
    """One minimum per sample: of the shingle hashes, times an odd factor and shifted, modulo 2**64."""
    factors = _FACTORS[WORDS * 4 :].reshape(-1, 2)
    mins = np.full(len(factors), np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(hashes), 2048):
        table = hashes[at : at + 2048] * factors[:, :1]
        table += factors[:, 1:]
        np.minimum(mins, table.min(axis=1), out=mins)
    return mins


def band_keys(mins: np.ndarray) -> np.ndarray:
    keys = np.arange(1, BANDS + 1, dtype=np.uint64)
    for row in range(ROWS):
        keys = _mixed(keys * _FACTORS[row] + mins[row::ROWS])
    return keys


def samples_of(hashes: np.ndarray) -> np.ndarray:
    """The minima of the bins that the hashes' leading bits name; sorted hashes, so a bin's minimum is the first in it."""
    bins = hashes >> np.uint64(64 - BINS)
    return hashes[np.flatnonzero(np.append(True, bins[1:] != bins[:-1]))]


def odd_sketch(samples: np.ndarray) -> np.ndarray:
    """A bitmap with the parity of how many samples fall on each bit."""
    bits = _mixed(samples) % np.uint64(64 * SKETCH)
    parity = np.bincount(bits.astype(np.int64), minlength=64 * SKETCH) & 1
    return np.packbits(parity.astype(np.uint8), bitorder="little").view(np.uint64)


def _signatures(batches: Iterator[pa.RecordBatch], percent: int = PERCENT) -> Iterator[pa.RecordBatch]:
    """Sets of up to ``WHOLE`` shingles have a sketch of all of them, larger ones of their samples, and those that may meet both have both."""

    def signed(array: np.ndarray) -> np.ndarray:
        return array.view(np.int64)

    for batch in batches:
        sizes, digests, bands, wholes, sketches, samples = [], [], [], [], [], []
        for text in batch.column("text"):
            found = shingles(text.as_py() or b"")
            sizes.append(len(found))
            if not len(found):
                digests.append(None)
                bands.append(None)
                wholes.append(None)
                sketches.append(None)
                samples.append(0)
                continue
            digests.append(hashlib.blake2b(found.astype("<u8").tobytes(), digest_size=16).digest())
            bands.append(signed(band_keys(minhash(found))))
            wholes.append(signed(odd_sketch(found)) if len(found) <= WHOLE else None)
            some = samples_of(found) if 100 * len(found) >= percent * WHOLE else None
            sketches.append(None if some is None else signed(odd_sketch(some)))
            samples.append(0 if some is None else len(some))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("body"),
                pa.array(sizes, pa.int64()),
                pa.array(digests, pa.binary()),
                pa.array(bands, pa.list_(pa.int64())),
                pa.array(wholes, pa.list_(pa.int64())),
                pa.array(sketches, pa.list_(pa.int64())),
                pa.array(samples, pa.int32()),
            ],
            names=["doc_id", "body", "n_shingles", "digest", "bands", "whole", "sketch", "samples"],
        )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    last = None
    for batch in batches:
        names, found = [], []
        for name, text in zip(batch.column("class").to_pylist(), batch.column("text")):
            if name != last:  # rows of one text come one after the other
                names.append(name)
                found.append(shingles(text.as_py()).view(np.int64))
                last = name
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(found, pa.list_(pa.int64()))], names=["class", "shingles"])


def differing_bits(a: str, b: str, sketch: str) -> Column:
    """How many bits of the two sketches differ, from the columns ``sketch`` of each."""
    differ = F.zip_with(f"{sketch}_{a}", f"{sketch}_{b}", lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    return F.aggregate(differ, F.lit(0), lambda total, count: total + count)


def likeness(a: str, b: str, percent: int, floor: int) -> Column:
    """The similarity that the sketches of two classes give, in hundredths; null if they are surely, or all but surely, no link.

    Of two sets of which all shingles are in the sketch, at least as many
    differ as bits do, so none of a link is missed. Larger sets are estimated.
    """
    sizes, bits = F.col(f"n_{a}") + F.col(f"n_{b}"), differing_bits(a, b, "whole")
    whole = F.when(bits * (100 + percent) <= sizes * (100 - percent), 100.0 * (sizes - bits) / (sizes + bits))
    shared = shared_samples(a, b)
    estimated = F.when(
        shared >= expected_samples(a, b, floor / 100) - SLACK, F.lit(float(percent)) * shared / expected_samples(a, b, percent / 100)
    )
    both = F.col(f"whole_{a}").isNotNull() & F.col(f"whole_{b}").isNotNull()
    alike = 100 * F.least(f"n_{a}", f"n_{b}") >= percent * F.greatest(f"n_{a}", f"n_{b}")
    return F.when(alike, F.when(both, whole).otherwise(estimated))


def shared_samples(a: str, b: str) -> Column:
    """How many samples two classes share, from the columns ``sketch_`` and ``samples_`` of each.

    The bits that differ tell how many samples are in one sketch alone.
    """
    bits = 64.0 * SKETCH
    share = F.greatest(1 - differing_bits(a, b, "sketch") * F.lit(2 / bits), F.lit(1e-9))
    return (F.col(f"samples_{a}") + F.col(f"samples_{b}") + F.lit(bits / 2) * F.log(share)) / 2


def expected_samples(a: str, b: str, similarity: float) -> Column:
    """How many samples two classes of a similarity share: of the bins that their union fills, that part.

    Shingles that fall into one bin leave one sample; how many did is known
    for each class, and the union is taken to have lost as large a share.
    """

    def filled(size: Column) -> Column:
        return F.lit(float(1 << BINS)) * (1 - F.exp(-size / F.lit(float(1 << BINS))))

    sizes = F.col(f"n_{a}") + F.col(f"n_{b}")
    found = (F.col(f"samples_{a}") + F.col(f"samples_{b}")) / (filled(F.col(f"n_{a}")) + filled(F.col(f"n_{b}")))
    return F.lit(similarity) * filled(sizes / F.lit(1 + similarity)) * found


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (a, b) whose full sets are similar enough, compared in the JVM."""
    left = sets.select(F.col("class").alias("a"), F.col("shingles").alias("of_a"))
    right = sets.select(F.col("class").alias("b"), F.col("shingles").alias("of_b"))
    both = pairs.join(left, "a").join(right, "b")
    shared = F.size(F.array_intersect("of_a", "of_b"))
    union = F.size("of_a") + F.size("of_b") - shared
    return both.where(100 * shared >= percent * union).select("a", "b")


def _with_component(rows: DataFrame, column: str, joined: DataFrame, into: str = "component") -> DataFrame:
    """The component of a class; a class without a link is its own."""
    own = joined.select(F.col("node").alias(column), F.col("component").alias("_found"))
    return rows.join(own, column, "left").withColumn(into, F.coalesce("_found", column)).drop("_found")


def _apart(pairs: DataFrame, joined: DataFrame) -> DataFrame:
    """The pairs (a, b) of different components."""
    both = _with_component(_with_component(pairs, "a", joined, "in_a"), "b", joined, "in_b")
    return both.where("in_a != in_b").select("a", "b")


def _bytes(text: Column) -> Column:
    return F.coalesce(text, F.lit("")).cast("binary")


def body(text: Column) -> Column:
    """The digest of a text that tells rows of one key apart; a missing text counts as empty."""
    return F.sha2(_bytes(text), 256)


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT, floor: int = FLOOR) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row, as ``decisions`` finds them, but for ``kept``.

    ``kept`` is doc_id = component_id: true for all rows that repeat a component's smallest key.
    """
    found = decisions(df, key, text, percent, floor).drop("body")
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def decisions(df: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT, floor: int = FLOOR) -> DataFrame:
    """doc_id, body, n_shingles, component_id, kept for every row; ``body`` is the text's digest.

    Rows are linked if 100 * shared shingles >= ``percent`` * all shingles of
    both; ``component_id`` is the smallest key that links reach. Of rows that
    links connect one is ``kept``: the first by key (missing ones last), then
    by digest of the text; of equal rows any one. Texts without words (null,
    empty, blank) are linked with nothing and kept. Rows with the same set of
    shingles share a class. Each row is judged by its own text, also where a
    key repeats; a missing key is never a component's smallest unless all are
    missing. An empty table gives no rows; other columns are ignored, whatever
    their names.
    """
    rows = df.select(F.col(key).cast("long").alias("doc_id"), body(F.col(text)).alias("body"), _bytes(F.col(text)).alias("text"))
    schema = "doc_id long, body string, n_shingles long, digest binary, bands array<long>, whole array<long>, sketch array<long>, samples int"
    # the number of a row is written with it, so it stays the same
    signed = stage(rows.mapInArrow(partial(_signatures, percent=percent), schema).withColumn("row", F.monotonically_increasing_id()), "signatures")
    same = {"n_shingles": "n", "bands": "bands", "whole": "whole", "sketch": "sketch", "samples": "samples"}  # alike in all rows of a class
    lowest = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "body", "row"))
    classes = stage(
        signed.where("digest IS NOT NULL")
        .groupBy(F.col("digest").alias("class"))
        .agg(lowest.alias("first"), *(F.any_value(c).alias(name) for c, name in same.items())),
        "classes",
    )

    members = classes.select("class", F.explode(F.array_distinct("bands")).alias("bucket"))
    order = F.struct(F.xxhash64("bucket", "class").alias("at"), F.col("class").alias("class"))
    leaders = stage(
        members.groupBy("bucket").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket", F.col("first.class").alias("leader")),
        "leaders",
    )
    shared = stage(members.join(leaders, "bucket"), "shared-buckets")
    sketches = stage(
        classes.join(shared.select("class").distinct(), "class", "left_semi").select("class", "first", "whole", "sketch", "samples", "n"), "sketches"
    )
    # keys may be missing or repeat, so a class's text is found by the digest of the text as well
    keys = sketches.select("class", F.col("first.doc_id").alias("least"), F.col("first.body").alias("own"))
    texts = rows.join(keys, rows["doc_id"].eqNullSafe(keys["least"]) & (rows["body"] == keys["own"])).select("class", "text")
    sets = stage(texts.mapInArrow(_sets, "class binary, shingles array<long>").dropDuplicates(["class"]), "sets")

    def side(name: str) -> DataFrame:
        return sketches.select(*(F.col(c).alias(f"{c}_{name}") for c in ("class", "whole", "sketch", "samples", "n"))).withColumnRenamed(f"class_{name}", name)

    like = likeness("a", "b", percent, floor)

    # each class and the leaders of its buckets: the likest first, then those of other components
    starred = shared.where("class != leader").select(F.col("class").alias("a"), F.col("leader").alias("b")).distinct()
    starred = stage(starred.join(side("a"), "a").join(side("b"), "b").select("a", "b", like.alias("like")).where("like IS NOT NULL"), "starred")
    nearest = starred.groupBy("a").agg(F.max(F.struct("like", "b")).alias("best")).select("a", F.col("best.b").alias("b"))
    links = stage(_linked(stage(nearest, "star-pairs"), sets, percent), "star-links")
    others = stage(_apart(starred.select("a", "b"), stage(components(links, rounds=1), "star-components")), "other-leaders")
    links = stage(links.unionAll(_linked(others, sets, percent)), "leader-links")
    joined = stage(components(links), "leader-components")

    # what is left: pairs of a bucket in different components
    placed = stage(_with_component(shared, "class", joined), "placed")
    ends = placed.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    still = placed.join(ends.where("low != high").select("bucket"), "bucket").join(sketches.drop("first"), "class")
    still = stage(still.join(classes.select("class", "bands"), "class"), "open-buckets")

    def half(name: str) -> DataFrame:
        return still.select("bucket", *(F.col(c).alias(f"{c}_{name}") for c in ("class", "component", "leader", "bands", "whole", "sketch", "samples", "n")))

    left, right = half("a"), half("b")
    apart = (F.col("class_a") < F.col("class_b")) & (F.col("component_a") != F.col("component_b"))
    compared = (F.col("class_a") == F.col("leader_a")) | (F.col("class_b") == F.col("leader_a"))
    # each pair from the first bucket that both are in, unless it was compared there
    once = F.element_at(F.array_intersect("bands_a", "bands_b"), 1) == left["bucket"]
    pairs = left.join(right, (left["bucket"] == right["bucket"]) & apart & ~compared & once & like.isNotNull())
    pairs = stage(pairs.select(F.col("class_a").alias("a"), F.col("class_b").alias("b")).distinct(), "open-pairs")
    links = stage(links.unionAll(_linked(pairs, sets, percent)), "all-links")
    joined = stage(components(links), "components")

    placed = stage(_with_component(classes.select("class", "first"), "class", joined).withColumnRenamed("class", "digest"), "class-components")
    of_component = stage(placed.groupBy("component").agg(F.min("first").alias("stays")), "component-rows")
    of_class = stage(placed.join(of_component, "component").select("digest", F.col("stays.doc_id").alias("component_id"), F.col("stays.row").alias("stays")), "class-ids")
    result = signed.select("doc_id", "body", "n_shingles", "digest", "row").join(of_class, "digest", "left")
    alone = F.col("digest").isNull()
    return result.select(
        "doc_id",
        "body",
        "n_shingles",
        F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        (alone | F.coalesce(F.col("row") == F.col("stays"), F.lit(False))).alias("kept"),
    )
