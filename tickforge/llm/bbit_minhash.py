"""Near duplicates by b-bit MinHash.

A document is its set of distinct word shingles.  Documents with equal sets form a class; one row per class goes on, so
copies cost nothing further.  A class has ``hashes`` minima: runs of four full minima make band keys, and the low
``BITS`` bits of every minimum are packed into a signature.  Classes that share a band are candidates; the share of
equal b-bit minima, corrected for chance collisions, is estimated from bit counts and drops the unlikely pairs; the
rest is confirmed on the full sets.

Candidates without all pairs of a bucket:

1. Every bucket links its members to its most central one, the class whose buckets are largest altogether: within a
   group of near copies that is the text they derive from.
2. Links found make components.  Where a bucket still holds several, every pair across components has a member outside
   the bucket's largest component, so those members meet all others in a second join.  Nothing else can be missed: pairs
   within a component need no link.  A pair leaves that join only if an exact bound allows it: shingles that no other
   class of such buckets has cannot be shared, so the copies of a text that differ too much from it, and from each
   other by what only they have, never become pairs.  These classes' texts are read again anyway, so they get a wider
   signature, too, and a pair leaves the first bucket it shares only.

Both steps are equi-joins on the band key, which adaptive execution splits when a bucket is large.  The number of bands
follows from the threshold: a pair just at it is missed with probability ``MISS`` at most.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tickforge.llm.common import components, quoted
from tickforge.session import stage

ROWS = 4                    # minima per band
BITS = 4                    # of each minimum in the signature
MISS = 1e-5
SLACK = 4.5                 # standard deviations below the threshold at which an estimate still counts
WIDE = 512                  # minima of the wider signature of classes in mixed buckets
CACHE = 300_000
MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def bands_for(threshold: float) -> int:
    return max(4, math.ceil(math.log(MISS) / math.log(1.0 - threshold ** ROWS)))


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * MIX[1]
    h = (h ^ (h >> np.uint64(27))) * MIX[2]
    return h ^ (h >> np.uint64(31))


class Shingler:
    """64-bit hashes of a text's distinct shingles, sorted.  The bounded cache of word hashes changes no result."""

    def __init__(self, words: int):
        self.words, self.cache = words, {}

    def __call__(self, text: str | None) -> np.ndarray:
        words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
        if not words:
            return np.zeros(0, dtype=np.uint64)
        cache = self.cache
        if len(cache) > CACHE:
            cache.clear()
        for w in set(words):
            if w not in cache:
                cache[w] = int.from_bytes(hashlib.blake2b(w, digest_size=8).digest(), "little")
        h = np.fromiter(map(cache.__getitem__, words), dtype=np.uint64, count=len(words))
        n = min(self.words, len(h))
        out = np.zeros(len(h) - n + 1, dtype=np.uint64)
        for k in range(n):
            out = _mix(out * MIX[0] + h[k:len(h) - n + 1 + k] + np.uint64(n))
        return np.unique(out)


def _coefficients(hashes: int) -> tuple[np.ndarray, np.ndarray]:
    r = np.random.default_rng(20)
    return (r.integers(1, 1 << 63, hashes, dtype=np.uint64) * np.uint64(2) + np.uint64(1),
            r.integers(0, 1 << 63, hashes, dtype=np.uint64))


def minima(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest value of each hash function over the set, in blocks of bounded size."""
    out = np.full(len(a), np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(shingles), 1024):
        h = shingles[at:at + 1024] * a[:, None] + b[:, None]
        h ^= h >> np.uint64(32)
        np.minimum(out, h.min(axis=1), out=out)
    return out


def signature(low: np.ndarray) -> list[int]:
    """The low BITS bits of every minimum in signed 64-bit words."""
    per = 64 // BITS
    bits = (low & np.uint64((1 << BITS) - 1)).reshape(-1, per)
    words = (bits << (np.arange(per, dtype=np.uint64) * np.uint64(BITS))).sum(axis=1, dtype=np.uint64)
    return words.view(np.int64).tolist()


SKETCH = "key string, tie bigint, n_shingles bigint, print binary, bands array<bigint>, sig array<bigint>"


def _sketch(words: int, bands: int, hashes: int):
    def run(batches):
        shingle, (a, b) = Shingler(words), _coefficients(hashes)
        for batch in batches:
            n, prints, keys_of, sigs = [], [], [], []
            for text in batch.column(2).to_pylist():
                s = shingle(text)
                n.append(len(s))
                if not len(s):
                    prints.append(None), keys_of.append(None), sigs.append(None)
                    continue
                low = minima(s, a, b)
                prints.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                runs = low[:bands * ROWS].reshape(bands, ROWS)
                key = np.arange(1, bands + 1, dtype=np.uint64)
                for k in range(ROWS):
                    key = _mix(key * MIX[0] + runs[:, k])
                keys_of.append(key.view(np.int64).tolist())
                sigs.append(signature(low))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(prints, pa.binary()),
                 pa.array(keys_of, pa.list_(pa.int64())), pa.array(sigs, pa.list_(pa.int64()))],
                names=["key", "tie", "n_shingles", "print", "bands", "sig"])
    return run


def _sets(words: int, wide: int):
    def run(batches):
        shingle, (a, b) = Shingler(words), _coefficients(wide)
        for batch in batches:
            sets = [shingle(t) for t in batch.column(0).to_pylist()]
            sigs = [signature(minima(s, a, b)) if wide and len(s) else [] for s in sets]
            yield pa.RecordBatch.from_arrays(
                [pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                 pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                 pa.array(sigs, pa.list_(pa.int64()))], names=["print", "shingles", "wide"])
    return run


def _unequal(p: Column, q: Column) -> Column:
    """How many b-bit minima of two signature words differ: the bits of each group of BITS are or-ed into its lowest,
    then counted."""
    low = sum(1 << k for k in range(0, 64, BITS))
    low -= 1 << 64 if low >= 1 << 63 else 0
    x = p.bitwiseXOR(q)
    folded = x
    for k in range(1, BITS):
        folded = folded.bitwiseOR(F.shiftrightunsigned(x, k))
    return F.bit_count(folded.bitwiseAND(F.lit(low)))


def differing(a: str, b: str, words: int | None = None) -> Column:
    """How many b-bit minima of two signatures differ; unrolled for signatures of a few ``words``."""
    if words is None:
        return F.aggregate(F.zip_with(a, b, _unequal), F.lit(0), lambda total, n: total + n)
    total = F.lit(0)
    for i in range(words):
        total = total + _unequal(F.col(a)[i], F.col(b)[i])
    return total


def most_differing(threshold: float, hashes: int) -> int:
    """The largest number of differing minima that a pair at the threshold may show.

    Equal minima agree in their low bits; others by chance, once in 2^BITS.  So the share of agreeing minima is
    similarity + (1 - similarity) / 2^BITS, give or take ``SLACK`` standard deviations.
    """
    chance = 0.5 ** BITS
    agree = threshold + (1.0 - threshold) * chance
    return math.ceil(hashes * (1.0 - agree) + SLACK * math.sqrt(hashes * agree * (1.0 - agree)))


def _full_sets(prints: DataFrame, source: DataFrame, chosen: DataFrame, words: int, wide: int = 0) -> DataFrame:
    """print, shingles, wide (stored) of the classes named; wide is a signature of that many minima.

    ``source``: key, text of all documents; ``chosen``: print, key of one document of each class.  Only the texts asked
    for are read again; rows that share a key but not a text are told apart by their full sets.
    """
    keys = chosen.join(prints, "print", "left_semi").select(F.col("key").alias("wanted")).distinct()
    return stage(source.join(stage(keys, "wanted"), F.col("key").eqNullSafe(F.col("wanted")), "left_semi").select("text")
                 .mapInArrow(_sets(words, wide), "print binary, shingles array<bigint>, wide array<bigint>")
                 .groupBy("print").agg(F.first("shingles").alias("shingles"), F.first("wide").alias("wide")), "sets")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (x, y) of classes whose full sets are similar enough."""
    joined = (pairs.join(sets.select(F.col("print").alias("y"), F.col("shingles").alias("sy")), "y")
              .join(sets.select(F.col("print").alias("x"), F.col("shingles").alias("sx")), "x"))
    both = joined.select("x", "y", F.size(F.array_intersect("sx", "sy")).cast("bigint").alias("i"),
                         (F.size("sx") + F.size("sy")).cast("bigint").alias("s"))
    return both.where(100 * F.col("i") >= percent * (F.col("s") - F.col("i"))).select("x", "y")


def _shared(sets: DataFrame) -> DataFrame:
    """print, shared: how many of a class's shingles any other class of ``sets`` has, too."""
    alone = (sets.select("print", F.explode("shingles").alias("shingle")).groupBy("shingle")
             .agg(F.count("*").alias("c"), F.first("print").alias("print")).where("c = 1")
             .groupBy("print").agg(F.count("*").alias("alone")))
    return sets.select("print", F.size("shingles").alias("n_all"), "wide").join(alone, "print", "left").select(
        "print", "wide", (F.col("n_all") - F.coalesce("alone", F.lit(0))).alias("shared"))


def groups(docs: DataFrame, words: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, n_shingles, component_id, kept, tie (hash of the text), group (null without words) for every row.

    Documents are linked at ``percent`` of their shingle sets' union or more.  With fewer words than a shingle, the
    whole sequence is one; without words (null, empty, blank) a document is linked with nothing and is its own
    component.  component_id is the smallest id reachable, kept marks that row.  Rows repeated with the same id are all
    kept or all not.  A null id takes part, but names no component: it is kept if nothing with an id is linked.
    """
    threshold = percent / 100.0
    bands = bands_for(threshold)
    per = 64 // BITS
    hashes = -(-bands * ROWS // per) * per
    kind = dict(docs.dtypes)[key]
    sketch = stage(docs.select(F.col(key).cast("string").alias("key"), F.xxhash64(text).alias("tie"),
                               F.col(text).alias("text")).mapInArrow(_sketch(words, bands, hashes), SKETCH), "sketches")
    own = F.col("key").cast(kind)
    classes = stage(sketch.where("print is not null").groupBy("print").agg(
        F.min(own).alias("least"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"),
        F.first("sig").alias("sig")), "classes")

    # band postings of classes that are not alone in the band
    posts = classes.select("print", "n", "sig", F.explode("bands").alias("band"))
    sizes = posts.groupBy("band").agg(F.count("*").alias("size")).where("size > 1")
    posts = stage(posts.join(sizes, "band"), "bands")
    central = posts.groupBy("print").agg(F.sum("size").alias("weight"))
    weighed = posts.join(central, "print")
    rep = F.struct("weight", "print", "sig", "n")
    heads = weighed.groupBy("band").agg(F.max(rep).alias("head")).select(
        F.col("band").alias("b"), F.col("head.print").alias("x"), F.col("head.sig").alias("xs"), F.col("head.n").alias("xn"))
    # sizes bound the similarity too: of two sets, at most the smaller's size is shared
    near = (differing("xs", "sig", hashes // per) <= most_differing(threshold, hashes)) & (
        100 * F.least("xn", "n") >= percent * F.greatest("xn", "n"))
    star = stage(posts.join(heads, (F.col("band") == F.col("b")) & (F.col("x") != F.col("print")) & near).select(
        F.least("x", "print").alias("x"), F.greatest("x", "print").alias("y")).distinct(), "candidates")

    source = docs.select(F.col(text).alias("text"), F.col(key).cast("string").alias("key"))
    chosen = classes.select("print", F.col("least").cast("string").alias("key"))
    asked = star.select(F.col("x").alias("print")).union(star.select("y")).distinct()
    links = stage(_confirmed(star, _full_sets(asked, source, chosen, words), percent), "links")
    first = stage(components(links, "x", "y"), "components")

    labelled = stage(posts.join(first, posts["print"] == first["node"], "left").select(
        "band", "print", "n", "sig", F.coalesce("component", "print").alias("component")), "labelled")
    of = labelled.groupBy("band", "component").agg(F.count("*").alias("size"))
    mixed = of.groupBy("band").agg(F.max(F.struct("size", "component")).alias("top"), F.count("*").alias("parts")).where(
        "parts > 1").select("band", F.col("top.component").alias("top"))
    members = stage(labelled.join(mixed, "band"), "members")
    sets = _full_sets(members.select("print").distinct(), source, chosen, words, WIDE)
    # what no other member has cannot be shared: the rest bounds the similarity from above
    members = stage(members.join(stage(_shared(sets), "shared"), "print").where(
        100 * F.col("shared") >= percent * F.col("n")).join(classes.select("print", "bands"), "print"), "members")
    stray = members.where(F.col("component") != F.col("top")).select(
        F.col("band").alias("b"), F.col("print").alias("x"), F.col("sig").alias("xs"), F.col("n").alias("xn"),
        F.col("component").alias("c"), F.col("shared").alias("xshared"),
        F.col("wide").alias("xwide"), F.col("bands").alias("xbands"))
    common = F.least("shared", "xshared")
    bound = 100 * common >= percent * (F.col("n") + F.col("xn") - common)
    # two strays of a bucket meet once
    apart = (F.col("c") != F.col("component")) & ((F.col("component") == F.col("top")) | (F.col("x") < F.col("print")))
    nearer = differing("xwide", "wide") <= most_differing(threshold, WIDE)
    # a pair of several buckets leaves the first of them only
    here = F.array_position("bands", F.col("band"))
    only = F.array_position(F.zip_with("bands", "xbands", lambda p, q: p == q), True) == here
    more = stage(members.join(stray, (F.col("band") == F.col("b")) & apart & bound & near & nearer & only).select(
        F.least("x", "print").alias("x"), F.greatest("x", "print").alias("y")).distinct().join(
        star, ["x", "y"], "left_anti"), "candidates")
    links = links.union(_confirmed(more, sets, percent))
    linked = components(links, "x", "y")

    ids = classes.select("print", "least").join(linked, F.col("print") == F.col("node"), "left").select(
        "print", "least", F.coalesce("component", "print").alias("component"))
    least = ids.groupBy("component").agg(F.min("least").alias("component_id"))
    named = ids.join(least, "component").select("print", "component_id", F.col("component").alias("group"))
    out = sketch.select("key", "tie", "n_shingles", "print").join(named, "print", "left").select(
        own.alias(key), "n_shingles", F.coalesce("component_id", own).alias("component_id"), "tie", "group")
    return out.select(key, "n_shingles", "component_id", F.coalesce(
        F.col(key) == F.col("component_id"), F.col("component_id").isNull()).alias("kept"), "tie", "group")


def deduplicated(docs: DataFrame, words: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` with one row of each group: the smallest id's, or, without any id, the smallest text hash's.

    Rows without words are in no group and stay.  Of rows alike in id and text one stays.  Columns are those of ``docs``.
    """
    found = stage(groups(docs, words, percent, key, text), "groups")
    one = found.where("group is not null and kept").groupBy("group").agg(F.min(F.struct(key, "tie")).alias("s"))
    copies = found.where("group is not null").groupBy(F.col(key).alias("k"), F.col("tie").alias("t")).agg(
        F.count("*").alias("n"))
    chosen = one.select(F.col(f"s.{key}").alias("_key"), F.col("s.tie").alias("_tie"))
    chosen = stage(chosen.join(copies, F.col("_key").eqNullSafe(F.col("k")) & (F.col("_tie") == F.col("t"))).select(
        "_key", "_tie", (F.col("n") > 1).alias("_again")), "chosen")
    # the row travels as one value: its columns may have any names
    rows = docs.select(F.col(key).alias("_key"), F.xxhash64(text).alias("_tie"), F.struct(*quoted(docs)).alias("row"),
                       F.coalesce(F.regexp_like(text, F.lit(r"[^\x20\x09-\x0D]")), F.lit(False)).alias("_words"))
    keys = chosen.select(F.col("_key").alias("k"), F.col("_tie").alias("t"), "_again")
    here = rows.where("_words").join(keys, F.col("_key").eqNullSafe(F.col("k")) & (F.col("_tie") == F.col("t")))
    again = here.where("_again").groupBy("_key", "_tie").agg(F.first("row").alias("row")).select("row")
    return here.where("not _again").select("row").union(again).union(rows.where("not _words").select("row")).select("row.*")
