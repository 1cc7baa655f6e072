"""Near duplicates by an LSH forest over MinHash signatures, confirmed on full shingle sets.

Documents with equal sets form a class, which takes part once. A class has one
path of ``DEPTH`` MinHash values in each of ``TREES`` trees. Each tree is a
sorted order of the paths; candidates are neighbours with a common prefix of
at least ``LEAST`` values. The prefix grows region by region: where more than
``REGION`` classes share it, the region splits by its next value, and so on
down the path. Regions of the full depth that are still larger are cut in the
order of the path.

A large region is mostly one text in many versions, and then its most copied
class, the hub, is near to most others. All members of a large region are
compared with its hub first, at whatever size the region has; other candidates
are then needed only between classes that the hubs have not joined already.

Regions of at most ``REGION`` classes are compared whole, each in one task. In
larger ones the splits only find most links early: classes of a large region
that still has several components then go through an exact join on their
rarest shingles, between different components. So no link depends on the size
of a region, on a batch or on a partition.

Each candidate is confirmed on the two full sets of 52-bit shingle hashes,
which are taken from the texts of the classes concerned. Links are joined into
components in Spark.

Defined results: words are cut at ASCII white space and A-Z is lower-cased; a
text with fewer words than a shingle has one shingle of all its words; a text
that is null or without words has none and is linked with nothing. Rows that
repeat an id share a component only if their texts do. Rows without id count
for links but never name a component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fiscalframe.llm.components import components
from fiscalframe.llm.shared import key_filter, packed, stored, unpacked
from fiscalframe.llm.shingles import batches, shingle_sets, signatures

TREES = 16
DEPTH = 8
LEAST = 3
REGION = 96
#: Of 128 values, cut to 4 bits: sets of similarity 0.8 agree in 104, give or take 4.4.
AGREEING = 86

#: Counters by which shingles are called rare.
COUNTERS = 1 << 18

_PATH_BYTES = 4 * DEPTH
_ROW = "doc_id long, text_hash long, n_shingles long, class_id long, signature binary, sketch binary"


def _signed(hashed: int) -> int:
    return hashed - (1 << 64) if hashed >> 63 else hashed


def shingled(documents: DataFrame, words: int) -> DataFrame:
    """One row per document: its number of shingles, the class of its set, its signature and a short sketch of that."""

    def rows(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in parts:
            texts = list(b["text"].fillna(""))
            for part in batches(texts):
                sets, begins = shingle_sets([texts[i] for i in part], words)
                signed = signatures(sets, begins, TREES * DEPTH)
                low = (signed & 0xF).astype(np.uint8)
                sketch = low[:, ::2] << 4 | low[:, 1::2]
                names = [_signed(xxhash.xxh3_64_intdigest(sets[i:j].tobytes())) for i, j in zip(begins, begins[1:], strict=False)]
                n = np.diff(begins)
                out = b[["doc_id", "text_hash"]].iloc[part].reset_index(drop=True)
                out["n_shingles"] = n
                out["class_id"] = pd.array(np.array(names, np.int64), "Int64")
                out.loc[n == 0, "class_id"] = pd.NA
                # Most significant byte first, so that bytes sort as the values do.
                out["signature"] = [s.tobytes() for s in signed.astype(">u4")]
                out["sketch"] = [s.tobytes() for s in sketch]
                yield out

    keyed = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), F.col("text").cast("string").alias("text"))
    return keyed.mapInPandas(rows, _ROW)


def _regions(paths: np.ndarray) -> np.ndarray:
    """A number for each row of a sorted table of paths; rows of one number are candidates for each other.

    A region ends where the common prefix gets too short; it is as shallow as
    its size allows.
    """
    n = len(paths)
    new = paths[1:] != paths[:-1]
    region, open_ = np.zeros(n, np.int64), np.ones(n, bool)
    base = 0
    for depth in range(LEAST, DEPTH + 1):
        # The tree's number stands before the values.
        run = np.concatenate([[0], np.cumsum(new[:, : 1 + 4 * depth].any(1))])
        size = np.bincount(run)[run]
        fits = open_ & (size <= REGION)
        region[fits] = base + run[fits]
        open_ &= ~fits
        base += n
    if open_.any():
        place = np.arange(n) - np.searchsorted(run, run, side="left")
        region[open_] = base + run[open_] * n + place[open_] // REGION
    return region


def _neighbours(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Candidate pairs of one sorted stretch of the forest; its last region waits for the next batch."""
    held: pd.DataFrame | None = None
    for b in parts:
        held = b if held is None else pd.concat([held, b], ignore_index=True)
        # The rows of an unfinished run at the least depth; a longer run is worked on in pieces.
        prefix = held["path"].iat[-1][: 1 + 4 * LEAST]
        keep = 0
        while keep < min(len(held), 64 * REGION) and held["path"].iat[-1 - keep].startswith(prefix):
            keep += 1
        if len(held) > keep:
            yield from _pairs(held.iloc[: len(held) - keep])
            held = held.iloc[len(held) - keep :]
    if held is not None:
        yield from _pairs(held)


def _pairs(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
    paths = np.frombuffer(b"".join(rows["path"]), np.uint8).reshape(len(rows), -1)
    region, ids = _regions(paths), rows["class_id"].to_numpy()
    alone = np.ones(len(rows), bool)
    alone[1:] &= region[1:] != region[:-1]
    alone[:-1] &= region[1:] != region[:-1]
    at = np.nonzero(~alone)[0]
    sketch = np.frombuffer(b"".join(rows["sketch"].iloc[at]), np.uint8).reshape(len(at), -1) if len(at) else np.empty((0, 1), np.uint8)
    region, ids, root = region[at], ids[at], rows["root"].to_numpy()[at]
    for ahead in range(1, REGION):
        i = np.nonzero(region[ahead:] == region[:-ahead])[0] if ahead < len(at) else ()
        if not len(i):
            return
        i = i[root[i] != root[i + ahead]]
        differ = sketch[i] ^ sketch[i + ahead]
        agree = ((differ & 0xF0) == 0).sum(1) + ((differ & 0x0F) == 0).sum(1)
        i = i[agree >= AGREEING]
        if len(i):
            yield pd.DataFrame({"a": np.minimum(ids[i], ids[i + ahead]), "b": np.maximum(ids[i], ids[i + ahead])})


def similar(shared: Column, a: Column, b: Column, percent: int) -> Column:
    return 100 * shared >= percent * (a + b - shared)


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` whose full sets are similar enough."""

    @F.pandas_udf("long")
    def shared(left: pd.Series, right: pd.Series) -> pd.Series:
        return pd.Series([len(np.intersect1d(np.frombuffer(x, np.int64), np.frombuffer(y, np.int64), assume_unique=True)) for x, y in zip(left, right, strict=True)], dtype="int64")

    size = lambda c: F.octet_length(c) / 8
    left = sets.select(F.col("class_id").alias("a"), F.col("shingles").alias("_x"))
    right = sets.select(F.col("class_id").alias("b"), F.col("shingles").alias("_y"))
    both = pairs.join(left, "a").join(right, "b")
    # Sets of too different sizes need no look inside.
    fair = both.filter(100 * F.least(size("_x"), size("_y")) >= percent * F.greatest(size("_x"), size("_y")))
    return fair.withColumn("_n", shared("_x", "_y")).filter(similar(F.col("_n"), size("_x"), size("_y"), percent)).select("a", "b")


def _class_sets(documents: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """``(class_id, shingles)`` of the wanted classes, from the text of one document of each."""

    def rows(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in parts:
            texts = list(b["text"])
            for part in batches(texts):
                sets, begins = shingle_sets([texts[i] for i in part], words)
                packed_sets = [sets[i:j].astype(np.int64).tobytes() for i, j in zip(begins, begins[1:], strict=False)]
                yield pd.DataFrame({"class_id": b["class_id"].iloc[part].to_numpy(), "shingles": packed_sets})

    # Null ids get a key too; the hash keeps them apart.
    key = F.coalesce(F.col("doc_id"), F.lit(0)).cast("long").alias("_key")
    texts = documents.select(key, F.xxhash64("text").alias("text_hash"), F.col("text").cast("string").alias("text"))
    # Only texts that may be wanted are shuffled.
    texts = texts.filter(key_filter(wanted.select(F.col("rep.text_hash").alias("h")), "h")(F.col("text_hash")))
    named = wanted.select("class_id", F.coalesce("rep.doc_id", F.lit(0)).alias("_key"), F.col("rep.text_hash").alias("text_hash"))
    found = texts.join(named.hint("merge"), ["_key", "text_hash"]).select("class_id", "text")
    return found.mapInPandas(rows, "class_id long, shingles binary").dropDuplicates(["class_id"])


def _forest(classes: DataFrame, *columns: str) -> DataFrame:
    """A row per class and tree: ``class_id``, the columns asked for, ``tree`` and ``path``, which sorts by tree and then value by value."""
    tree = F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree")
    branch = F.substr(F.col("signature"), F.col("tree") * _PATH_BYTES + 1, F.lit(_PATH_BYTES))
    path = F.concat(F.unhex(F.lpad(F.hex("tree"), 2, "0")), branch)
    return classes.select("class_id", *columns, "signature", tree).select("class_id", *columns, "tree", path.alias("path"))


def _stored_sets(documents: DataFrame, classes: DataFrame, wanted: DataFrame, most: int, words: int) -> DataFrame:
    """``(class_id, shingles)`` of the classes wanted, of which there are ``most`` at most."""
    reps = stored(classes.select("class_id", "rep").join(wanted, "class_id"), "reps", most)
    return stored(_class_sets(documents, reps, words), "sets")


def _linked(documents: DataFrame, classes: DataFrame, pairs: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs that are confirmed on the sets of their texts."""
    pairs = stored(pairs, "pairs")
    wanted = pairs.select(F.col("a").alias("class_id")).union(pairs.select("b")).distinct()
    return stored(confirmed(pairs, _stored_sets(documents, classes, wanted, 2 * pairs.count(), words), percent), "links")


def _often(sets: DataFrame):
    """About how many of the sets hold a shingle, in ``COUNTERS`` counters by its lower bits, as a broadcast of that size."""
    size = COUNTERS

    def counted(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(size, np.int64)
        for b in parts:
            if len(b):
                total += np.bincount(np.frombuffer(b"".join(b["shingles"]), np.int64) & (size - 1), minlength=size)
        cell = np.nonzero(total)[0]
        yield pd.DataFrame({"cell": cell, "n": total[cell]})

    held = sets.select("shingles").mapInPandas(counted, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    table = np.zeros(size, np.int64)
    table[held["cell"].to_numpy()] = held["n"].to_numpy()
    return sets.sparkSession.sparkContext.broadcast(table)


def _rarest(sets: DataFrame, percent: int) -> DataFrame:
    """``class_id, root, size, shingle, place``: the first shingles of each set, so many that a similar set shares one.

    Every set is put into the same order, rare shingles first as far as the
    counters tell. Any order loses no pair; it only has to be the same for all.
    """
    often = _often(sets)

    def rows(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in parts:
            kept = []
            for packed_set in b["shingles"]:
                shingles = np.frombuffer(packed_set, np.int64)
                most = len(shingles) + percent * len(shingles) // -100 + 1
                kept.append(shingles[np.lexsort((shingles, often.value[shingles & (len(often.value) - 1)]))[:most]])
            n = [len(k) for k in kept]
            if sum(n):
                of = np.repeat(np.arange(len(b)), n)
                place = np.concatenate([np.arange(1, k + 1) for k in n])
                size = (b["shingles"].str.len() // 8).to_numpy()[of]
                yield pd.DataFrame({"class_id": b["class_id"].to_numpy()[of], "root": b["root"].to_numpy()[of], "size": size, "shingle": np.concatenate(kept), "place": place})

    columns = sets.select("class_id", "root", "shingles")
    return stored(columns.mapInPandas(rows, "class_id long, root long, size long, shingle long, place long"), "rare")


def exact_pairs(sets: DataFrame, percent: int) -> DataFrame:
    """Pairs of different ``root`` among ``(class_id, root, shingles)``: all that can be similar enough, and others.

    Two similar sets share one of the rarest shingles of each; any order of the
    shingles gives all pairs, and the rarest first give the fewest.
    """
    rare = _rarest(sets, percent)
    # Per shingle, all but its most frequent root meet all, so joined classes do not meet each other.
    main = rare.groupBy("shingle", "root").agg(F.count("*").alias("n")).groupBy("shingle").agg(F.max(F.struct("n", "root"))["root"].alias("main"))
    left = rare.join(main.hint("merge"), "shingle").filter("root != main")
    left = left.select("shingle", F.col("class_id").alias("x"), F.col("root").alias("x_root"), F.col("size").alias("x_size"), F.col("place").alias("x_place"))
    met = left.join(rare, "shingle").filter("root != x_root")
    fair = 100 * F.least("size", "x_size") >= percent * F.greatest("size", "x_size")
    # The shared shingles from this one on; the first one that two sets share lets a similar pair pass.
    rest = 1 + F.least(F.col("size") - F.col("place"), F.col("x_size") - F.col("x_place"))
    met = met.filter(fair & ((100 + percent) * rest >= percent * (F.col("size") + F.col("x_size"))))
    return met.select(F.least("x", "class_id").alias("a"), F.greatest("x", "class_id").alias("b")).distinct()


def _crowd(members: DataFrame, roots: DataFrame) -> DataFrame:
    """``(class_id, root)`` of the members of large regions that still hold several components."""
    rooted = members.select("class_id", "prefix").join(roots.hint("merge"), "class_id", "left").withColumn("root", F.coalesce("root", "class_id"))
    several = rooted.groupBy("prefix").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low != high")
    return rooted.join(several.hint("merge"), "prefix").select("class_id", "root").distinct()


def near_duplicates(documents: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, text_hash, n_shingles, class_id, root, component_id``, one row per document.

    ``component_id`` is the smallest id reachable over links of at least
    ``percent``; ``root`` names the component even where ids are missing.
    """
    if percent < 80:
        raise ValueError(f"the forest and the sketch are laid out for 80 percent or more, not {percent}")
    rows = stored(shingled(documents, words), "shingled")
    # The first document by id stands for a class; the ones without id come last.
    rep = F.min(F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "text_hash"))
    grouped = rows.filter("class_id is not null").groupBy("class_id")
    classes = grouped.agg(F.count("*").alias("copies"), F.first("signature").alias("signature"), F.first("sketch").alias("sketch"), rep.alias("rep"))
    classes = stored(classes, "classes")

    prefix = F.xxhash64(F.substring("path", 1, 1 + 4 * LEAST))
    placed = _forest(classes, "copies").select("class_id", "copies", "tree", prefix.alias("prefix"))
    large = placed.groupBy("prefix").agg(F.count("*").alias("n")).filter(F.col("n") > REGION).select("prefix")
    members = stored(placed.join(large.hint("merge"), "prefix"), "members")
    hub = members.groupBy("prefix").agg(F.max(F.struct("copies", "class_id"))["class_id"].alias("hub"))
    spokes = members.join(hub.hint("merge"), "prefix").filter("class_id != hub")
    spokes = spokes.select(F.least("class_id", "hub").alias("a"), F.greatest("class_id", "hub").alias("b")).distinct()
    hubs = _linked(documents, classes, spokes, words, percent)

    # Classes that the hubs have joined need no comparison with each other.
    joined = components(hubs).select(F.col("id").alias("class_id"), "root")
    known = classes.join(joined.hint("merge"), "class_id", "left").withColumn("root", F.coalesce("root", "class_id"))
    in_large = members.groupBy("class_id").agg(F.bit_or(F.call_function("shiftleft", F.lit(1), F.col("tree"))).alias("large"))
    known = known.join(in_large.hint("merge"), "class_id", "left").withColumn("large", F.coalesce("large", F.lit(0)))
    forest = _forest(known, "sketch", "root", "large").withColumn("large", F.call_function("shiftright", F.col("large"), F.col("tree")).bitwiseAND(F.lit(1)) == 1)
    forest = forest.select("class_id", "sketch", "root", "path", "large")
    # A small region is never cut: all of it is in one task. Large ones may be cut anywhere.
    small = forest.filter("not large").repartition(F.substring("path", 1, 1 + 4 * LEAST)).sortWithinPartitions("path", "class_id")
    cut = forest.filter("large").repartitionByRange("path", "class_id").sortWithinPartitions("path", "class_id")
    near = small.mapInPandas(_neighbours, "a long, b long").union(cut.mapInPandas(_neighbours, "a long, b long")).distinct()
    links = hubs.unionByName(_linked(documents, classes, near, words, percent))
    final = components(links)

    crowd = stored(_crowd(members, final.select(F.col("id").alias("class_id"), "root")), "crowd", members.count())
    if several := crowd.count():
        sets = _stored_sets(documents, classes, crowd.select("class_id"), several, words)
        pairs = stored(exact_pairs(sets.join(crowd, "class_id"), percent), "pairs")
        final = components(links.unionByName(stored(confirmed(pairs, sets, percent), "links")))

    rooted = classes.select("class_id", "rep.doc_id").join(final.withColumnRenamed("id", "class_id"), "class_id", "left")
    rooted = stored(rooted.select("class_id", "doc_id", F.coalesce("root", "class_id").alias("root")), "rooted")
    first = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = rooted.select("class_id", "root").join(first, "root")
    kept = rows.select("doc_id", "text_hash", "n_shingles", "class_id")
    # Rows without shingles stay out of the join: their key is null, and hot.
    told = kept.filter("class_id is not null").join(named, "class_id").select(*kept.columns, "root", "component_id")
    bare = kept.filter("class_id is null").select("*", F.lit(None).cast("long").alias("root"), F.col("doc_id").alias("component_id"))
    return told.unionByName(bare)


def _key(doc_id: Column, text_hash: Column) -> Column:
    """One hash for a document, whether it has an id or not."""
    return F.xxhash64(doc_id.isNull(), doc_id, text_hash)


def drop_near_copies(documents: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One document of each component, the one with the smallest id, with all its columns.

    Documents without shingles stay.
    """
    keys = ["doc_id", "text_hash"]
    found = stored(near_duplicates(documents, words, percent).filter("root is not null").groupBy("root", *keys).agg(F.count("*").alias("n")), "found")
    first = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("missing"), *keys)).alias("rep"))
    judged = found.join(first.hint("merge"), "root")
    stays = F.col("doc_id").eqNullSafe(F.col("rep.doc_id")) & (F.col("text_hash") == F.col("rep.text_hash"))
    # Rows to look at: those that go, and the ones that stay but are repeated.
    touched = stored(judged.select(*keys, stays.alias("stays"), "n").filter("not stays or n > 1"), "touched", found.count())
    touched = touched.select(_key(F.col("doc_id"), F.col("text_hash")).alias("_key"), "stays")
    row = documents.select(packed(documents).alias("_row"), _key(F.col("doc_id").cast("long"), F.xxhash64("text")).alias("_key"))
    maybe = key_filter(touched, "_key")(F.col("_key"))
    joined = row.filter(maybe).join(touched.hint("merge"), "_key", "left")
    nth = F.row_number().over(Window.partitionBy("_key").orderBy("stays"))
    kept = joined.withColumn("_nth", nth).filter("stays is null or (stays and _nth = 1)")
    # All other rows stay, and never leave their scan.
    return unpacked(row.filter(~maybe).select("_row").unionByName(kept.select("_row")))
