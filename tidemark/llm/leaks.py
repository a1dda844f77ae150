"""Test items leaking into documents, by greedy string tiling.

Documents and items are cut into runs of SEED words in Spark and joined on their hashes; a bit table of fixed size with all
item seeds keeps the documents' other runs from being shuffled. Each pair that shares a seed is then tiled by running
Karp-Rabin: hashes of a search length find the longest matches of what is still unmarked, these are marked longest first,
none overlapping another, and the search length goes down to SEED. The longest tile and the share of the item's words
under tiles tell a leak, the latter also of a passage whose parts were reordered.

Defined results: null or empty texts and passages, and those under SEED words, share nothing; repeated rows count each;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.looks import one_form
from tidemark.llm.wordhash import _powers, distinct, grams, mix, word_hashes
from tidemark.session import stage

#: Words of the least tile, words that in a row make a leak, and the first search length.
SEED, RUN, LONG = 8, 12, 32
#: Bits of the table of item seeds: 16 MB, however many items there are. It only keeps away seeds that no item has.
TABLE_BITS, SLICES = 27, 256
#: Rows of a shared seed on one side that go to one task; the rows of a more frequent seed are salted.
HOT = 10_000


def words_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of texts in one form; case, punctuation and white space do not matter."""
    return word_hashes(one_form(texts))


def _windows(words: np.ndarray, free: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all unmarked runs of n words, and their Karp-Rabin hashes."""
    if len(words) < n:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    up, down = _powers(1 << max(19, int(len(words) + 1).bit_length()))
    with np.errstate(over="ignore"):
        sums = np.concatenate([[np.uint64(0)], np.cumsum(words * up[: len(words)])])
        marked = np.concatenate([[0], np.cumsum(~free)])
        at = np.flatnonzero(marked[n:] == marked[:-n])
        return at, mix((sums[at + n] - sums[at]) * down[at])


def _matches(doc: np.ndarray, item: np.ndarray, free_d: np.ndarray, free_i: np.ndarray, n: int) -> list[tuple[int, int, int]]:
    """(-length, doc position, item position) of all maximal unmarked matches of n words or more."""
    at_d, h_d = _windows(doc, free_d, n)
    at_i, h_i = _windows(item, free_i, n)
    o = np.argsort(h_i, kind="stable")
    at_i, h_i = at_i[o], h_i[o]
    found = []
    for a in range(0, len(at_d), 65_536):
        d, h = at_d[a : a + 65_536], h_d[a : a + 65_536]
        lo, hi = np.searchsorted(h_i, h, "left"), np.searchsorted(h_i, h, "right")
        i = np.repeat(d, hi - lo)
        j = at_i[np.arange(len(i)) - np.repeat(np.cumsum(hi - lo) - (hi - lo), hi - lo) + np.repeat(lo, hi - lo)] if len(i) else i
        # Only where a match starts: before it a word differs, is marked or is none.
        start = (i == 0) | (j == 0)
        k = np.flatnonzero(~start)
        start[k] = (doc[i[k] - 1] != item[j[k] - 1]) | ~free_d[i[k] - 1] | ~free_i[j[k] - 1]
        for x, y in zip(i[start].tolist(), j[start].tolist()):
            most = min(len(doc) - x, len(item) - y)
            same = (doc[x : x + most] == item[y : y + most]) & free_d[x : x + most] & free_i[y : y + most]
            length = most if same.all() else int(same.argmin())
            if length >= n:
                found.append((-length, x, y))
    return found


def tiles(doc: np.ndarray, item: np.ndarray, least: int = SEED) -> list[tuple[int, int, int]]:
    """Greedy tiles (doc position, item position, length): the longest unmarked match first, until none has `least` words."""
    doc, item = doc.astype(np.uint64, copy=False), item.astype(np.uint64, copy=False)
    free_d, free_i = np.ones(len(doc), bool), np.ones(len(item), bool)
    found: list[tuple[int, int, int]] = []
    n = max(least, min(LONG, len(doc), len(item)))
    while True:
        queue = _matches(doc, item, free_d, free_i, n)
        longest = -min(queue)[0] if queue else 0
        if longest > 2 * n:  # long matches first, so that few starts are looked at
            queue = [x for x in queue if -x[0] > longest // 2]
        heapify(queue)
        while queue:
            size, x, y = heappop(queue)
            free = free_d[x : x - size] & free_i[y : y - size]
            if free.all():
                free_d[x : x - size], free_i[y : y - size] = False, False
                found.append((x, y, -size))
                continue
            edge = np.flatnonzero(np.diff(np.concatenate([[0], free.astype(np.int8), [0]])))
            for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):  # what is left of it waits for its turn
                if b - a >= max(n, longest // 2 + 1 if longest > 2 * n else n):
                    heappush(queue, (a - b, x + a, y + a))
        if longest > 2 * n:
            continue
        if n == least:
            return found
        n = max(least, n // 2)


def _item_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each item's words and different seeds."""
    for pdf in batches:
        h, at = words_of(pdf["passage"].tolist())
        yield pd.DataFrame({"item_id": pdf["item_id"].to_numpy(np.int64), "words": [x.tobytes() for x in _split(h, at, len(pdf))], "seeds": [distinct(x.view(np.int64)) for x in _split(*grams(h, at, SEED), len(pdf))]})


def _split(values: np.ndarray, owner: np.ndarray, n: int) -> list[np.ndarray]:
    return np.split(values, np.searchsorted(owner, np.arange(1, n))) if n else []


def _slot(seeds: np.ndarray) -> np.ndarray:
    return (seeds.view(np.uint64) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


def seed_table(items: DataFrame) -> bytes:
    """A bit for each seed of an item, by the seed's first bits. Tasks set bits by slice; only the table reaches the driver."""
    width = (1 << TABLE_BITS) // SLICES

    def pre(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                slots = distinct(_slot(np.concatenate([*pdf["seeds"], np.empty(0, np.int64)]).astype(np.int64)))
                cuts = np.searchsorted(slots, np.arange(SLICES + 1) * width)
                yield pd.DataFrame([(k, (slots[a:b] - k * width).astype(np.uint32).tobytes()) for k, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())) if b > a], columns=["slice", "slots"])

    def merge(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        bits = np.zeros(width, bool)
        for s in pdf["slots"]:
            bits[np.frombuffer(s, np.uint32)] = True
        return pd.DataFrame({"slice": [key[0]], "bits": [np.packbits(bits).tobytes()]})

    found = {r.slice: bytes(r.bits) for r in items.select("seeds").mapInPandas(pre, "slice int, slots binary").groupBy("slice").applyInPandas(merge, "slice int, bits binary").collect()}
    return b"".join(found.get(k, bytes(width // 8)) for k in range(SLICES))


def _document_hits(table):
    """Documents with a seed that the table has: their words, and these seeds."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits = np.frombuffer(table.value, np.uint8)
        for whole in batches:
            for i in range(0, len(whole), 256):
                pdf = whole.iloc[i : i + 256]
                h, at = words_of(pdf["text"].tolist())
                g, ga = grams(h, at, SEED)
                slot = _slot(g)
                hit = (bits[slot >> 3] >> (7 - (slot & 7)) & 1).astype(bool)
                seeds, words = _split(g[hit], ga[hit], len(pdf)), _split(h, at, len(pdf))
                rows = [(d, w.tobytes(), distinct(s.view(np.int64))) for d, w, s in zip(pdf["doc_id"].tolist(), words, seeds) if len(s)]
                yield pd.DataFrame(rows, columns=["doc_id", "words", "seeds"])

    return run


def _tiled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = []
        for d, i, x, y in zip(pdf["doc_id"], pdf["item_id"], pdf["words"], pdf["passage_words"]):
            item = np.frombuffer(y, np.uint64)
            got = tiles(np.frombuffer(x, np.uint64), item)
            if got:
                rows.append((d, i, max(n for _, _, n in got), sum(n for _, _, n in got) / len(item)))
        yield pd.DataFrame(rows, columns=["doc_id", "item_id", "longest", "coverage"])


def leak_tiles(documents: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, item_id, longest (words), coverage of every pair that shares SEED words in a row."""
    words = stage(items.where("passage is not null").select("item_id", "passage").mapInPandas(_item_words, "item_id bigint, words binary, seeds array<bigint>").withColumn("place", F.monotonically_increasing_id()), "items")
    table = documents.sparkSession.sparkContext.broadcast(seed_table(words))
    texts = documents.where("text is not null").select("doc_id", "text")
    hits = stage(texts.mapInPandas(_document_hits(table), "doc_id bigint, words binary, seeds array<bigint>").withColumn("row", F.monotonically_increasing_id()), "hits")
    # Rows go by numbers of their own, so that repeated ids stay apart. A seed of many documents is split by AQE's skew join.
    asked = stage(words.select("place", F.explode("seeds").alias("seed")), "seeds")
    often = asked.groupBy("seed").agg(F.count("*").alias("n")).where(F.col("n") > HOT).select("seed", F.ceil(F.col("n") / HOT).cast("int").alias("salts"))
    asked = asked.join(often, "seed", "left").select("seed", "place", F.when(F.col("salts").isNull(), 0).otherwise(F.pmod(F.xxhash64("place"), "salts")).cast("int").alias("salt"))
    told = hits.select("row", F.explode("seeds").alias("seed")).join(often, "seed", "left")
    told = told.select("seed", "row", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)).alias("salt"))
    pairs = stage(told.join(asked, ["seed", "salt"]).select("row", "place").distinct(), "seeded")
    both = pairs.join(hits.select("row", "doc_id", "words"), "row").join(words.select("place", "item_id", F.col("words").alias("passage_words")), "place")
    return both.select("doc_id", "item_id", "words", "passage_words").mapInPandas(_tiled, "doc_id bigint, item_id bigint, longest int, coverage double")


def leaked_items(documents: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, item_id where a document holds at least RUN words of the passage in a row."""
    return leak_tiles(documents, items).where(F.col("longest") >= RUN).select("doc_id", "item_id")


def leak_report(documents: DataFrame, items: DataFrame, coverage: float = 0.5) -> DataFrame:
    """item_id, suite, documents, longest, coverage: the items leaked whole, in part or reordered."""
    hit = leak_tiles(documents, items).where((F.col("longest") >= RUN) | (F.col("coverage") >= coverage))
    by = hit.groupBy("item_id").agg(F.countDistinct("doc_id").alias("documents"), F.max("longest").alias("longest"), F.round(F.max("coverage"), 6).alias("coverage"))
    return by.join(items.select("item_id", "suite"), "item_id").select("item_id", "suite", "documents", "longest", "coverage")
