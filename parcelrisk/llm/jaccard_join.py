"""N-gram Jaccard join by universe partitioning and the pigeonhole principle.

A document is the set of its distinct word shingles. Sets are grouped into size bands; two sets that link lie in one
band or in neighbouring ones, so a set is listed for its own band and, if large enough, for the next one. For a band
the largest possible difference H of two linking sets is known. The universe is cut by hash into segments:

* In m = H + 1 + E segments at least E + 1 must agree exactly. A set may so leave out up to E empty segments, which
  agree by accident; a set with more lists them all the same.
* Of m = H // 2 + 1 segments one must differ by one element at most, which a segment's signature along with those
  of its one-deletion neighbourhood finds.

Which of the two is cheaper is decided per band from the number of its sets: signatures to shuffle against
accidental matches. Candidates are verified exactly, on the shingles themselves.

Equal sets are one class from the start. Within the sets of a signature only one is compared with the others at first,
each set with its likeliest partner, for a few rounds with another one each; what is linked so forms components, and a
group of many near copies costs a few comparisons per copy. What is left are candidates in different components. Those
of small signature groups are compared if they share as many signatures as linking sets of their sizes must. Sets of a
crowded signature, as of a passage that many documents in different components share, are asked for a second key that linking sets have in
common: with all their shingles put in one order, the rarest first, one of the first size - overlap + 1, where the
overlap is the smallest that a link of their sizes allows. How rare a shingle is, a table of counts by its hash tells, so
that only those first shingles become rows. Of the pairs that share such a key, those whose sketches differ by more bits than
linking sets have different shingles are never made: a sketch has the parity of the set's shingles in each of 256 hash classes,
so each different shingle changes one bit at most. No link between components is lost.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelrisk.llm.common import blocks, concat_ranges, map_rows, mix64, stored, text_or_empty, type_of
from parcelrisk.llm.components import connected_components

KNOWN_WORDS = 500_000
CHANCE = 0.005   # assumed share of unrelated sets that agree on one element of a segment
VERIFY = 1.0     # cost of an accidental match, in shuffled signatures; most are dropped by their count, unread
GROWTH = 1.4     # of the size from band to band
BAND_BITS = 8    # of a signature, which tell its band
CROWD = 32       # of other components' sets that a set of a signature meets on average, up to which all such pairs are candidates
WIDE = 256       # sets of a signature, beyond which they are crowded in any case
STAR_ROUNDS = 3  # in which each set is compared with one set of a signature
SLOTS = 1 << 22    # by which the shingles of crowded sets are counted, for the order of the second key
LEVEL_PARTS = 256  # of the slots, which are added up on their own
PARITIES = ["p0", "p1", "p2", "p3"]   # of a sketch
SMALL_IDS = 500_000    # as many ids are broadcast; more of them are joined by a shuffle
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > KNOWN_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


@lru_cache(maxsize=1)
def _hashes() -> WordHashes:
    return WordHashes()


def lower_words(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_LOWER).split()


def shingle_hashes(text: str, n: int) -> np.ndarray:
    """Distinct 64-bit hashes of the shingles of ``n`` words; of all words if there are fewer; none without words."""
    words = lower_words(text)
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_hashes().__getitem__, words), np.uint64, len(words))
    out = np.full(max(1, len(h) - n + 1), min(n, len(h)), np.uint64)
    for j in range(min(n, len(h))):
        out = mix64(out ^ h[j:j + len(out)]) + h[j:j + len(out)]
    return np.unique(out)


def shingle_set(text: str, n: int) -> set[bytes]:
    """The shingles themselves."""
    words = lower_words(text)
    if not words:
        return set()
    n = min(n, len(words))
    return {b" ".join(words[i:i + n]) for i in range(len(words) - n + 1)}


def links(a: set[bytes], b: set[bytes], percent: int) -> bool:
    if not a or not b:
        return False
    common = len(a & b)
    return 100 * common >= percent * (len(a) + len(b) - common)


class Bands:
    """Size bands and, for each, the way it is indexed.

    A set is listed for its own band and, if it is large enough to link with one of the next band, for that too.
    """

    def __init__(self, percent: int, largest: int):
        self.percent = percent
        self.starts = [1]
        while len(self.starts) < 2 or self.starts[-2] <= largest:
            self.starts.append(max(self.starts[-1] + 1, int(self.starts[-1] * GROWTH)))
        n = len(self.starts)
        self.segments, self.extra = np.ones(n, np.int64), np.zeros(n, np.int64)
        self.deletion = np.zeros(n, bool)

    def difference(self, sizes: int) -> int:
        """The largest difference of two linking sets, from the sum of their sizes."""
        return (100 - self.percent) * sizes // (100 + self.percent)

    def band_of(self, sizes: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, sizes, side="right") - 1

    def listed(self, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(set number, band) of all listings."""
        own = self.band_of(sizes)
        above = np.minimum(own + 1, len(self.starts) - 1)
        reach = np.flatnonzero((100 * sizes >= self.percent * np.array(self.starts)[above]) & (above > own))
        return np.concatenate([np.arange(len(sizes)), reach]), np.concatenate([own, above[reach]])

    def allocate(self, sets_of_size: dict[int, int]) -> Bands:
        """Chooses the cheaper index for each band, given how many sets there are of each size."""
        sizes = np.array(sorted(sets_of_size), np.int64)
        number, band = self.listed(sizes)
        listed = np.bincount(band, np.array([sets_of_size[int(x)] for x in sizes])[number], len(self.starts)) if len(sizes) else np.zeros(len(self.starts))
        for b in range(len(self.starts)):
            top = self.starts[b + 1] - 1 if b + 1 < len(self.starts) else self.starts[b]
            h, size = self.difference(2 * top), self.starts[b]
            m, extra = h + 1, 0
            while h:  # room for the empty segments that a set of the band has by chance
                empty = m * math.exp(-self.percent / 100 * size / m)
                new = h + 1 + math.ceil(empty + 2 * math.sqrt(empty))
                if new <= m or new > 2 * (h + 1):
                    break
                m, extra = new, new - h - 1
            d = h // 2 + 1
            exact = m + VERIFY * m * listed[b] * CHANCE ** max(2, size / m)
            deletion = d + size + VERIFY * d * listed[b] * CHANCE ** max(1, size / d - 1)
            if h and deletion < exact:
                self.deletion[b], self.segments[b] = True, d
            else:
                self.segments[b], self.extra[b] = m, extra
        return self

    def signatures(self, sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(set number, signature) of sets of hashes, none of them empty. A signature's low bits are its band."""
        sizes = np.array([len(x) for x in sets], np.int64)
        starts = np.cumsum(sizes) - sizes
        number, band = self.listed(sizes)
        reps = sizes[number]
        listing = np.repeat(np.arange(len(number)), reps)
        x = mix64(np.concatenate(sets)[concat_ranges(starts[number], reps)] ^ mix64(band.astype(np.uint64))[listing])
        m = self.segments[band]
        base = np.cumsum(m) - m                                    # segments of all listings are numbered through
        segment = base[listing] + ((x >> np.uint64(33)).astype(np.int64) % m[listing])
        order = np.argsort(segment, kind="stable")
        segment, x = segment[order], mix64(x[order] + np.uint64(1))
        first = np.flatnonzero(np.concatenate([[True], segment[1:] != segment[:-1]]))
        found, sums, counts = segment[first], np.add.reduceat(x, first), np.diff(np.append(first, len(x)))
        owner = np.searchsorted(base, found, side="right") - 1
        salt = mix64(((found - base[owner]) << 16 | band[owner]).astype(np.uint64))   # of segment and band

        by_deletion = self.deletion[band]
        total = int(m.sum())
        filled = np.bincount(found, minlength=total)
        skips = ~by_deletion & (m - np.add.reduceat(filled, base) <= self.extra[band])   # listings that leave empty segments out
        out = [(owner, sums ^ salt)]
        empty = np.flatnonzero(filled == 0)
        empty_owner = np.searchsorted(base, empty, side="right") - 1
        empty, empty_owner = empty[~skips[empty_owner]], empty_owner[~skips[empty_owner]]
        out.append((empty_owner, mix64(((empty - base[empty_owner]) << 16 | band[empty_owner]).astype(np.uint64))))
        less = np.repeat(by_deletion[owner], counts)               # one-deletion neighbourhoods
        if less.any():
            out.append((np.repeat(owner, counts)[less], ((np.repeat(sums, counts) - x) ^ np.repeat(salt, counts))[less]))
        owner, sig = (np.concatenate(v) for v in zip(*out, strict=True))
        sig = mix64(sig) & ~np.uint64((1 << BAND_BITS) - 1) | (band[owner] % (1 << BAND_BITS)).astype(np.uint64)
        return number[owner], sig

    def needed(self, band: int, sizes: int) -> int:
        """How many signatures of a band two linking sets share at least, from the sum of their sizes."""
        if self.deletion[band]:
            return 1
        return max(1, int(self.segments[band]) - self.difference(sizes) - int(self.extra[band]))


def sketches_of(sets: list[np.ndarray]) -> np.ndarray:
    """256 bits of each set of hashes, as four integers: the parity of its elements of each class."""
    out = np.empty((len(sets), 4), np.int64)
    for i, x in enumerate(sets):
        out[i] = np.packbits((np.bincount((x >> np.uint64(56)).astype(np.int64), minlength=256) & 1).astype(np.uint8)).view(np.int64)
    return out


def shingle_sets(docs: DataFrame, n: int, id_col: str, text_col: str) -> DataFrame:
    """(id, n_shingles, h1, h2): the set's size and a 128-bit hash of it, which doesn't depend on order."""
    def run(rows: Iterator[tuple]) -> Iterator[dict]:
        for part in blocks(rows, lambda r: len(r[1]), 4_000_000):
            sets = [shingle_hashes(t, n) for _, t in part]
            yield {"id": [r[0] for r in part], "n_shingles": [len(s) for s in sets],
                   "h1": [int(mix64(s).sum().view(np.int64)) if len(s) else 0 for s in sets],
                   "h2": [int(mix64(s ^ np.uint64(0xA5A5)).sum().view(np.int64)) if len(s) else 0 for s in sets]}

    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(F.col(text_col)).alias("text"))
    return map_rows(rows, run, f"id {type_of(docs, id_col)}, n_shingles long, h1 long, h2 long")


def _signature_rows(texts: DataFrame, bands: Bands, n: int) -> DataFrame:
    """(id, sig) of each text; no row twice."""
    model = texts.sparkSession.sparkContext.broadcast(bands)

    def run(rows: Iterator[tuple]) -> Iterator[dict]:
        for part in blocks(rows, lambda r: len(r[1]), 1_000_000):
            sets = [(i, s) for i, s in ((i, shingle_hashes(t, n)) for i, t in part) if len(s)]
            if sets:
                number, sig = model.value.signatures([s for _, s in sets])
                order = np.lexsort((sig, number))
                number, sig = number[order], sig[order]
                new = np.concatenate([[True], (number[1:] != number[:-1]) | (sig[1:] != sig[:-1])])
                ids = pa.array([i for i, _ in sets])
                yield {"id": ids.take(pa.array(number[new])), "sig": sig[new].view(np.int64)}

    return map_rows(texts.select("id", "text"), run, f"id {type_of(texts, 'id')}, sig long")


def _only(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """The texts of some ids; the ids are broadcast if they are counted to be few."""
    return texts.join(F.broadcast(ids) if ids.count() <= SMALL_IDS else ids, "id", "left_semi")


def _verified(pairs: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets link, written down."""
    pairs = stored(pairs.select("a", "b"), "pairs")
    a = _only(texts, pairs.select(F.col("a").alias("id")).distinct()).select(F.col("id").alias("a"), F.col("text").alias("ta"))
    b = _only(texts, pairs.select(F.col("b").alias("id")).distinct()).select(F.col("id").alias("b"), F.col("text").alias("tb"))

    def run(rows: Iterator[tuple]) -> Iterator[dict]:
        last, own = None, set()
        for part in blocks(rows, lambda r: len(r[2]) + len(r[3]), 2_000_000):
            out: dict[str, list] = {"a": [], "b": []}
            for x, y, s, t in part:
                if s != last:
                    last, own = s, shingle_set(s, n)
                if links(own, shingle_set(t, n), percent):
                    out["a"].append(x)
                    out["b"].append(y)
            yield out

    kind = type_of(texts, "id")
    joined = pairs.join(b, "b").join(a, "a").select("a", "b", "ta", "tb")
    return stored(map_rows(joined, run, f"a {kind}, b {kind}"), "links")


def _likely(pairs: DataFrame, classes: DataFrame, bands: Bands) -> DataFrame:
    """Of (a, b, band, k) the pairs whose sizes may link and that share as many signatures as such sets must."""
    sized = classes.groupBy(F.col("rep").alias("id")).agg(F.min("n_shingles").alias("lo"), F.max("n_shingles").alias("hi"))
    rows = [(b, int(bands.segments[b] - bands.extra[b]), bool(bands.deletion[b])) for b in range(len(bands.starts))]
    known = F.broadcast(pairs.sparkSession.createDataFrame(rows, "band long, most long, deletion boolean"))  # a row per band
    sizes = F.col("ha") + F.col("hb")
    difference = F.floor((100 - bands.percent) * sizes / (100 + bands.percent))
    return (pairs.join(sized.select(F.col("id").alias("a"), F.col("lo").alias("la"), F.col("hi").alias("ha")), "a")
            .join(sized.select(F.col("id").alias("b"), F.col("lo").alias("lb"), F.col("hi").alias("hb")), "b").join(known, "band")
            .filter((100 * F.col("ha") >= bands.percent * F.col("lb")) & (100 * F.col("hb") >= bands.percent * F.col("la"))
                    & (F.col("deletion") | (F.col("k") >= F.col("most") - difference)))
            .select("a", "b").distinct())


def _star_pairs(shared: DataFrame, reached: DataFrame, turn: int) -> DataFrame:
    """(a, b): each set with the one that leads most of its signatures in this turn, if that lies in another component."""
    marked = shared.join(reached, "id", "left").select("sig", "id", F.coalesce("component", "id").alias("component"))
    leads = (marked.groupBy("sig").agg(F.min(F.struct(F.xxhash64("id", F.lit(turn)).alias("h"), F.col("id").alias("a"), F.col("component").alias("ca"))).alias("s"),
                                       F.min("component").alias("lo"), F.max("component").alias("hi"))
             .filter("lo < hi").select("sig", "s.a", "s.ca"))
    stars = marked.join(leads, "sig").filter("component <> ca").groupBy("a", F.col("id").alias("b")).agg(F.count("*").alias("k"))
    return stars.groupBy("b").agg(F.max(F.struct("k", "a")).alias("s")).select(F.col("s.a").alias("a"), "b")


def crowded_sets(crowded: DataFrame, texts: DataFrame, n: int) -> DataFrame:
    """(id, component, size, e, p0 to p3), written down: the hashes of each set as one packed value, and its sketch."""
    def run(rows: Iterator[tuple]) -> Iterator[dict]:
        for part in blocks(rows, lambda r: len(r[2]), 500_000):
            found = [(i, c, x) for i, c, x in ((i, c, shingle_hashes(t, n)) for i, c, t in part) if len(x)]
            sketches = sketches_of([x for _, _, x in found])
            yield ({"id": [i for i, _, _ in found], "component": [c for _, c, _ in found], "size": [len(x) for _, _, x in found],
                    "e": [x.tobytes() for _, _, x in found]} | {p: sketches[:, i] for i, p in enumerate(PARITIES)})

    kind = type_of(texts, "id")
    known = F.broadcast(crowded) if crowded.count() <= SMALL_IDS else crowded
    schema = f"id {kind}, component {kind}, size long, e binary, " + ", ".join(f"{p} long" for p in PARITIES)
    return stored(map_rows(texts.join(known, "id").select("id", "component", "text"), run, schema), "crowded-sets")


def slots_of(hashes: np.ndarray) -> np.ndarray:
    return (mix64(hashes + np.uint64(2)) & np.uint64(SLOTS - 1)).astype(np.int64)


def shingle_levels(sets: DataFrame) -> np.ndarray:
    """One byte for each of SLOTS slots: eight times the logarithm of how many shingles of the packed sets fall into it, 0 if it is one.

    Tasks count their own rows; the counts are added up by parts of the slots, and what reaches the driver doesn't grow with the sets.
    """
    width = SLOTS // LEVEL_PARTS

    def run(rows: Iterator[tuple]) -> Iterator[dict]:
        counts = np.zeros(SLOTS, np.int32)
        for (e,) in rows:
            np.add.at(counts, slots_of(np.frombuffer(e, np.uint64)), 1)
        for part in range(LEVEL_PARTS):
            own = counts[part * width:(part + 1) * width]
            used = np.flatnonzero(own)
            if len(used):
                yield {"part": [part], "slots": [used.astype(np.int32).tobytes()], "counts": [own[used].tobytes()]}

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(width, np.int64)
        for slots, counts in zip(table["slots"].to_pylist(), table["counts"].to_pylist(), strict=True):
            total[np.frombuffer(slots, np.int32)] += np.frombuffer(counts, np.int32)
        levels = np.minimum(255, 8 * np.log2(np.maximum(total, 1))).astype(np.uint8)
        return pa.table({"part": table["part"][:1], "levels": pa.array([levels.tobytes()], pa.binary())})

    counted = map_rows(sets.select("e"), run, "part int, slots binary, counts binary")
    found = stored(counted.groupBy("part").applyInArrow(add, "part int, levels binary"), "shingle-levels").collect()
    out = np.zeros(SLOTS, np.uint8)
    for r in found:   # SLOTS bytes in all
        out[r["part"] * width:(r["part"] + 1) * width] = np.frombuffer(r["levels"], np.uint8)
    return out


def second_keys(sets: DataFrame, percent: int) -> DataFrame:
    """(id, component, size, place, e, p0 to p3): the shingles that may be the first one that a packed set has in common with
    a linking set, with their places; not those that no other set has."""
    levels = sets.sparkSession.sparkContext.broadcast(shingle_levels(sets))

    def run(rows: Iterator[tuple]) -> Iterator[dict]:
        for part in blocks(rows, lambda r: r[2], 100_000):
            chosen, places = [], []
            for r in part:
                x = np.frombuffer(r[3], np.uint64)
                level = levels.value[slots_of(x)]
                order = np.lexsort((x, level))[:len(x) + (-percent * len(x)) // 100 + 1]   # size less the least overlap, and one
                place = np.flatnonzero(level[order] > 0)
                chosen.append(x[order[place]])
                places.append(place + 1)
            reps = pa.array(np.repeat(np.arange(len(part)), [len(x) for x in chosen]))
            i, component, size, _, *sketch = (pa.array(c).take(reps) for c in zip(*part, strict=True))
            yield ({"id": i, "component": component, "size": size, "place": np.concatenate(places), "e": np.concatenate(chosen).view(np.int64)}
                   | dict(zip(PARITIES, sketch, strict=True)))

    kind = type_of(sets, "id")
    schema = f"id {kind}, component {kind}, size long, place long, e long, " + ", ".join(f"{p} long" for p in PARITIES)
    return stored(map_rows(sets, run, schema), "second-keys")


def crowded_pairs(crowded: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """(a, b): the pairs of (id, component) in different components that share a second key; all that link are among them.

    Linking sets of sizes s and t share at least percent * (s + t) / (100 + percent) shingles, so in any order of the
    shingles their first common one is among the first s - overlap + 1 of either. The order is by how many shingles of the
    crowded sets fall into a shingle's slot, so a shared passage comes last and hardly ever counts; any order by the shingle
    alone loses no link. Only those first shingles become rows. A pair whose sketches differ too much is left out.
    """
    keys = second_keys(crowded_sets(crowded, texts, n), percent)
    mixed = keys.groupBy("e").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo < hi").select("e")
    keys = stored(keys.join(mixed, "e", "left_semi").distinct(), "mixed-keys")
    left, right = (keys.select("e", *[F.col(c).alias(f"{side}_{c}") for c in ("id", "component", "size", "place", *PARITIES)]) for side in "ab")
    sizes = F.col("a_size") + F.col("b_size")
    overlap = F.ceil(percent * sizes / (100 + percent))
    may_link = ((100 * F.col("a_size") >= percent * F.col("b_size")) & (100 * F.col("b_size") >= percent * F.col("a_size"))
                & (F.col("a_place") <= F.col("a_size") - overlap + 1) & (F.col("b_place") <= F.col("b_size") - overlap + 1))
    bits = sum((F.bit_count(F.col(f"a_{p}").bitwiseXOR(F.col(f"b_{p}"))) for p in PARITIES), F.lit(0))
    near = (100 + percent) * bits <= (100 - percent) * sizes
    return (left.join(right, "e").filter((F.col("a_component") != F.col("b_component")) & (F.col("a_id") < F.col("b_id")) & may_link & near)
            .select(F.col("a_id").alias("a"), F.col("b_id").alias("b")).distinct())


def jaccard_components(docs: DataFrame, n: int = 4, percent: int = 85, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns id, n_shingles and component_id, the smallest id that links reach.

    Null or blank text has an empty set, which links with nothing: its component is its own id. Documents of equal
    sets link. Rows of one id count as one document with both texts' links; a null id is its own component (null).
    Other columns are ignored; an empty table gives an empty one.
    """
    sets = stored(shingle_sets(docs, n, id_col, text_col), "sets")
    classes = sets.filter((F.col("n_shingles") > 0) & F.col("id").isNotNull()).groupBy("n_shingles", "h1", "h2").agg(F.min("id").alias("rep"))
    classes = stored(classes, "classes")  # one row per different set
    sizes = {r["n_shingles"]: r["count"] for r in classes.groupBy("n_shingles").count().collect()}  # a row per set size
    bands = Bands(percent, max(sizes, default=1)).allocate(sizes)

    # signatures that different sets share; of equal sets only the smallest id's text is indexed
    kind = type_of(sets, "id")
    texts = docs.select(F.col(id_col).alias("id"), text_or_empty(F.col(text_col)).alias("text")).filter("id is not null")
    reps = classes.select(F.col("rep").alias("id")).distinct()
    copies = sets.filter("n_shingles > 0").select("id").distinct().join(reps, "id", "left_anti")
    copies = stored(copies.filter("id is not null"), "copies")
    one_each = texts.join(F.broadcast(copies) if copies.count() <= SMALL_IDS else copies, "id", "left_anti")
    by_sig = Window.partitionBy("sig").orderBy("id")
    shared = stored(_signature_rows(one_each, bands, n)
                    .withColumn("low", F.first("id").over(by_sig.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
                    .withColumn("more", F.lead("id").over(by_sig)).filter("low < id or low < more").select("sig", "id", "low"), "shared")

    # first round: each set with the smallest id that shares most signatures with it
    stars = shared.filter("low < id").groupBy(F.col("low").alias("a"), F.col("id").alias("b")).agg(F.count("*").alias("k"))
    best = stars.groupBy("b").agg(F.max(F.struct("k", "a")).alias("s")).select(F.col("s.a").alias("a"), "b")
    first = _verified(best, texts, n, percent)
    reached = stored(connected_components(first, kind), "reached")  # id, component; only of ids in a link
    for turn in range(1, STAR_ROUNDS):
        more = _verified(_star_pairs(shared, reached, turn), texts, n, percent)
        first = stored(first.union(more), "links")
        reached = stored(connected_components(first, kind), "reached")

    # last round: candidates between different components
    marked = shared.join(reached, "id", "left").select("sig", "id", F.coalesce("component", "id").alias("component"))
    spans = (marked.groupBy("sig", "component").agg(F.count("*").alias("c"))
             .groupBy("sig").agg(F.sum("c").alias("sets"), F.sum(F.col("c") * F.col("c")).alias("own"), F.count("*").alias("several")).filter("several > 1")
             .select("sig", ((F.col("sets") > CROWD) & ((F.col("sets") > WIDE) | (F.col("sets") * F.col("sets") - F.col("own") > CROWD * F.col("sets")))).alias("crowd")))
    mixed = stored(marked.join(spans, "sig").distinct(), "mixed")
    crowded = stored(mixed.filter("crowd").select("id", "component").distinct(), "crowded")
    # a pair of which one isn't crowded shares signatures of small groups only
    few = mixed.filter("not crowd").join(crowded.select("id", F.lit(True).alias("in_crowd")), "id", "left")
    few = few.withColumn("in_crowd", F.col("in_crowd").isNotNull())
    left = few.select("sig", F.col("id").alias("a"), F.col("component").alias("ca"), F.col("in_crowd").alias("wa"))
    right = few.select("sig", F.col("id").alias("b"), F.col("component").alias("cb"), F.col("in_crowd").alias("wb"))
    open_pairs = (left.join(right, "sig").filter((F.col("ca") != F.col("cb")) & (F.col("a") < F.col("b")) & ~(F.col("wa") & F.col("wb")))
                  .groupBy("a", "b", F.expr(f"sig & {(1 << BAND_BITS) - 1}").alias("band")).agg(F.count("*").alias("k")))
    last = _likely(open_pairs, classes, bands)
    if not crowded.isEmpty():
        last = last.union(crowded_pairs(crowded, texts, n, percent)).distinct()
    second = _verified(last, texts, n, percent)
    equal = (sets.join(classes, ["n_shingles", "h1", "h2"]).filter("id > rep").select(F.col("rep").alias("a"), F.col("id").alias("b")))
    all_links = stored(first.union(second).union(equal), "all-links")
    found = connected_components(all_links, kind)
    return (sets.join(found, "id", "left")
            .select(F.col("id").alias(id_col), "n_shingles", F.coalesce("component", "id").alias("component_id")))
