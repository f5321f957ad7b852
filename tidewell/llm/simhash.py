"""SimHash near-duplicates by covering locality-sensitive hashing.

Every bit position gets a vector of ``radius + 1`` bits. For each non-zero vector v of as
many bits one table keeps the positions whose vector has an odd product with v. Up to
``radius`` differing positions have vectors that some v is orthogonal to, so in that table
both fingerprints keep the same bits: every pair within the radius collides somewhere.
"""

from __future__ import annotations

from itertools import starmap

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import arrow_batch, slices, table
from tidewell.llm.components import components
from tidewell.scratch import written

BITS, WORDS, SEED, RADIUS = 64, 3, 42, 2
#: Fingerprints of a bucket that are compared pair by pair; larger buckets meet over
#: their one-bit neighbours instead, which loses nothing.
PAIRWISE = 24
ARROW = pa.schema([("doc_id", pa.int64()), ("bits", pa.int64())])


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """The 64-bit fingerprint as an unsigned number; 0 without words.

    ``bytes.lower`` and ``bytes.split`` touch A-Z and the six ASCII spaces only.
    """
    tokens = (text or "").encode("utf-8").lower().split()
    if not tokens:
        return 0
    if len(tokens) < words:
        hashes = [xxhash.xxh64_intdigest(b" ".join(tokens), SEED)]
    else:
        shingles = map(b" ".join, zip(*(tokens[i:] for i in range(words)), strict=False))
        hashes = starmap(xxhash.xxh64_intdigest, ((s, SEED) for s in shingles))
    found = np.fromiter(hashes, "<u8")
    ones = np.zeros(BITS, np.int64)
    for start in range(0, len(found), 4096):
        part = found[start : start + 4096].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    set_bits = np.packbits(2 * ones > len(found), bitorder="little")
    return int(set_bits.view("<u8")[0])


def _fingerprints(batches):
    for batch in slices(batches):
        found = [fingerprint(t) for t in batch.column(1).to_pylist()]
        signed = [x - (1 << 64) if x >> 63 else x for x in found]
        yield arrow_batch([batch.column(0).to_pylist(), signed], ARROW)


def masks(radius: int = RADIUS) -> list[int]:
    """The kept positions of each table as a signed number."""
    out = []
    for v in range(1, 1 << (radius + 1)):
        kept = 0
        for i in range(BITS):
            vector = 1 + i % ((1 << (radius + 1)) - 1)
            kept |= ((vector & v).bit_count() & 1) << i
        out.append(kept - (1 << 64) if kept >> 63 else kept)
    return out


def _edges(prints: DataFrame) -> DataFrame:
    """Links (a, b) between fingerprints that differ in at most two bits, complete up to
    reachability. ``prints`` has one row (bits) for each different fingerprint."""
    keys = F.array(*(F.col("bits").bitwiseAND(F.lit(m)) for m in masks()))
    placed = prints.select("bits", F.posexplode(keys).alias("table", "key"))
    crowded = written(
        placed.groupBy("table", "key").agg(F.count("*").alias("n")).where("n > 1"), "simhash-buckets"
    )
    met = written(placed.join(crowded, ["table", "key"]), "simhash-met")
    close = lambda x, y: F.bit_count(x.bitwiseXOR(y)) <= RADIUS
    pairs = (
        met.where(F.col("n") <= PAIRWISE)
        .groupBy("table", "key")
        .agg(F.collect_list("bits").alias("all"))
        .select(
            F.explode(
                F.flatten(
                    F.transform(
                        "all",
                        lambda x, i: F.transform(
                            F.filter(F.slice("all", i + 2, F.size("all")), lambda y: close(x, y)),
                            lambda y: F.struct(x.alias("a"), y.alias("b")),
                        ),
                    )
                )
            ).alias("pair")
        )
        .select("pair.*")
    )
    # Two fingerprints share a one-bit neighbour (or are one) exactly when they differ in
    # two bits at most, and a neighbour has 65 fingerprints around it at most.
    around = F.array(F.col("bits"), *(F.col("bits").bitwiseXOR(F.lit(_bit(i))) for i in range(BITS)))
    flips = met.where(F.col("n") > PAIRWISE).select("bits").distinct().select("bits", F.explode(around).alias("key"))
    least = written(flips.groupBy("key").agg(F.min("bits").alias("b"), F.count("*").alias("n")).where("n > 1").drop("n"), "simhash-flips")
    stars = flips.join(least, "key").select(F.col("bits").alias("a"), "b").where("a != b").distinct()
    return pairs.unionByName(stars)


def _bit(i: int) -> int:
    return -(1 << 63) if i == 63 else 1 << i


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id) per row of ``docs``.

    A null text counts as empty: fingerprint zero, linked like any other. Equal fingerprints
    are one node, so a group of copies costs one row after the first combine; ids are no nodes:
    rows that repeat an id with other texts do not link their fingerprints. A row without id
    links like any other and has the least id it reaches, null if there is none. Repeated rows
    give repeated rows. Other columns are ignored.
    """
    narrow = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    hashed = written(narrow.mapInArrow(_fingerprints, "doc_id long, bits long"), "simhash-prints")
    prints = written(hashed.groupBy("bits").agg(F.min("doc_id").alias("rep")), "simhash-reps")
    found = components(_edges(prints.select("bits")))
    rooted = written(
        prints.join(found, prints["bits"] == found["id"], "left").select(
            "bits", "rep", F.coalesce("component", "bits").alias("root")
        ),
        "simhash-rooted",
    )
    least = rooted.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = written(rooted.join(least, "root").select("bits", "component_id"), "simhash-named")
    return hashed.join(named, "bits", "left").select(
        "doc_id",
        F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def op8_simhash(spark, folder):
    return simhash_components(table(spark, folder, "documents"))


def first_of_each(spark, docs: DataFrame, folder: str) -> DataFrame:
    """Pipeline stage: of each component the row with the least doc_id.

    Rows without id link nothing and stay; of rows repeated with one id all stay or go.
    """
    found = simhash_components(docs.where("doc_id is not null"))
    first = written(found.where("doc_id = component_id").select("doc_id").distinct(), "simhash-first")
    # Shuffled at every size: whether the kept ids fit a broadcast depends on the data.
    kept = docs.join(first.hint("merge"), "doc_id", "left_semi").select(*docs.columns)
    return kept.unionByName(docs.where("doc_id is null"))
