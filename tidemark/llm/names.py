"""Variant spellings of organisations, linked by trie joins.

Each distinct spelling is read into the words of the name itself; legal forms, places in brackets, articles and words
for a trade fall away. Names are sharded by their words, and by their words less one letter; in a shard, the rest of
each name goes into a trie, which a Levenshtein automaton walks for all neighbours within the bound, in whatever order
the words came. Of linked names the one borne by most rows stands for the organisation. Abbreviated, shortened and other
known names join the one organisation they fit.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from itertools import combinations, permutations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import stage, unstage

#: Edits over a whole name; a swap of neighbours is one. Names this short allow one edit, shorter ones none.
EDITS, ONE_EDIT_BELOW, NO_EDIT_BELOW = 2, 9, 5
#: Names of one shard handled in one trie; larger shards are cut into blocks and their blocks paired.
BLOCK = 2048

#: Legal forms and words around a name. Fixed values.
LEGAL = frozenset(
    "inc incorporated ltd limited llc llp lp plc co corp corporation company companies group holding holdings ag sa s gmbh mbh kg nv bv ab as a oy kk pty spa srl sas se ug the and of und et kgaa pllc".split()
)
#: Words for a trade with their short forms. Fixed values.
TRADES = {
    "therapeutics": "tx thera ther therap therapeutic",
    "biosciences": "biosci bioscience bios bsci",
    "medicines": "med meds medicine medic",
    "oncology": "onco onc oncol",
    "pharma": "phma ph phar pharmas",
    "pharmaceuticals": "pharm pharmaceut pharmaceutical pharmac pharmaceu",
    "biologics": "bx biol biologic biolog",
    "genomics": "gx genom genomic gen",
    "biotech": "biotechnology biotechnologies",
    "laboratories": "labs lab",
    "health": "healthcare",
    "bio": "bios",
    "diagnostics": "dx diagn",
    "sciences": "sci science",
    "vaccines": "vax vacc",
    "technologies": "tech technology",
}
_TRADE = {w for k, v in TRADES.items() for w in (k, *v.split())}
#: What stands where no name is known. Fixed values.
PLACEHOLDERS = frozenset(
    "|-|--|—|–|?|.|n/a|na|n.a.|none|null|nil|nan|tbd|tba|tbc|unknown|undisclosed|not disclosed|undisclosed buyer|undisclosed seller|undisclosed target|undisclosed acquirer|undisclosed party|not named|unnamed|confidential|various|anonymous|not available|unspecified|not specified|private investor|private investors|private buyer|investors|several investors".split("|")
)


def osa(a: str, b: str, most: int) -> int:
    """Edits from a to b, swaps of neighbours as one; most + 1 beyond most."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    before: list[int] = []
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            v = min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1)
            if i and j and x == b[j - 1] and y == a[i - 1]:
                v = min(v, before[j - 1] + 1)
            new.append(v)
        before, row = row, new
        if min(row) > most:
            return most + 1
    return row[-1]


def is_trade(word: str) -> bool:
    return word in _TRADE or len(word) >= 5 and any(len(t) >= 6 and osa(word, t, 1 if len(t) < 8 else 2) <= (1 if len(t) < 8 else 2) for t in TRADES)


_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z][a-z]{2,})")
_TOKEN = re.compile(r"[a-z0-9]+\.?")


def plain(name: str) -> str:
    """Lower case without accents, white space as one space."""
    s = "".join(c for c in unicodedata.normalize("NFKD", name) if not unicodedata.combining(c))
    return re.sub(r"\s+", " ", s).strip().lower()


def words_of(name: str) -> tuple[list[str], list[bool]]:
    """The words of the name itself, and whether each is cut short with a point."""
    if plain(name) in PLACEHOLDERS:
        return [], []
    camel = name if name.isupper() else _CAMEL.sub(" ", re.sub(r"\bBioSci\b", "Biosci", name))
    s = plain(re.sub(r"\([^)]*\)", " ", camel))
    s = re.sub(r"\b([a-z])\.([a-z])\.", r"\1\2", s).replace("'", "").replace("’", "")  # s.a.
    words, cut = [], []
    for t in _TOKEN.findall(s):
        w = t.rstrip(".")
        if w in LEGAL and not (len(w) == 1 and t.endswith(".")):
            continue
        if is_trade(w):
            continue
        words.append(w)
        cut.append(t.endswith("."))
    return words, cut


class Trie:
    """Words in a tree of letters, walked with the states of a Levenshtein automaton."""

    def __init__(self):
        self.root: dict = {}

    def add(self, word: str, value: object) -> None:
        node = self.root
        for c in word:
            node = node.setdefault(c, {})
        node.setdefault("", []).append(value)

    def within(self, word: str, most: int) -> Iterator[tuple[object, int]]:
        """Values of all words within most edits, and the edits."""
        first = list(range(len(word) + 1))
        todo = [(self.root, first, None, "")]
        while todo:
            node, row, before, last = todo.pop()
            for value in node.get("", ()) if row[-1] <= most else ():
                yield value, row[-1]
            for c, child in node.items():
                if c == "":
                    continue
                new = [row[0] + 1]
                for j, y in enumerate(word):
                    v = min(row[j] + (c != y), row[j + 1] + 1, new[j] + 1)
                    if before is not None and j and c == word[j - 1] and y == last:
                        v = min(v, before[j - 1] + 1)
                    new.append(v)
                if min(new) <= most or min(row) <= most - 1:
                    todo.append((child, new, row, c))


def allowed(letters: int) -> int:
    return 0 if letters < NO_EDIT_BELOW else 1 if letters < ONE_EDIT_BELOW else EDITS


def less_one(word: str) -> set[str]:
    return {word[:i] + word[i + 1 :] for i in range(len(word))} | {word}


def less_two(word: str) -> set[str]:
    return {v for u in less_one(word) for v in less_one(u)}


def shards_of(core: str) -> Iterator[tuple[str, str, str]]:
    """shard, the word by which, the rest: whole words, words less a letter, and the name run together."""
    words = core.split(" ")
    letters = sum(map(len, words))
    for i, w in enumerate(words):
        rest = " ".join(words[:i] + words[i + 1 :])
        if rest:
            yield f"w{w}", w, rest
            if allowed(letters) >= 2:
                for v in less_one(w):
                    yield f"d{v}", w, rest
    for p in permutations(words) if len(words) <= 3 else (words,):
        run = "".join(p)
        for v in less_one(run) if allowed(letters) else {run}:
            yield f"j{v}", run, ""
    run = "".join(words)
    if len(words) == 1 and allowed(letters) >= 2:
        for v in less_two(run):
            yield f"t{v}", run, ""
    if len(words) > 3 or len(words) == 1 and letters >= NO_EDIT_BELOW:  # one of many words run together in another order
        for v in less_one("".join(sorted(run))):
            yield f"a{v}", core, ""


def reordered(words: list[str], run: str, most: int) -> bool:
    """Is a run of letters the words in some order, within most edits? Orders are left as soon as their beginning does not fit."""

    def go(done: str, left: list[str]) -> bool:
        if not left:
            return osa(done, run, most) <= most
        for w in sorted(set(left)):
            new = done + w
            if any(osa(new, run[: max(0, len(new) + k)], most) <= most for k in range(-most, most + 1)):
                rest = list(left)
                rest.remove(w)
                if go(new, rest):
                    return True
        return False

    return go("", words)


def _shards(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = [(s, core, w, rest) for core in pdf["core"] for s, w, rest in set(shards_of(core))]
        yield pd.DataFrame(rows, columns=["shard", "core", "word", "rest"])


def _apart(words: list[str]) -> Iterator[tuple[str, tuple[str, ...]]]:
    """Of more than three words, those shared by name (in sorted order) and up to EDITS others, which edits may touch."""
    for r in range(EDITS + 1):
        for out in combinations(range(len(words)), r):
            yield " ".join(sorted(w for i, w in enumerate(words) if i not in out)), tuple(words[i] for i in out)


def _shard_links(names: list[tuple[int, str, str, str]], runs: bool = False) -> Iterator[tuple[str, str]]:
    """Links among the names of one shard: those of the left block against the tries of the right.

    Up to three words go into the trie in every order. Of more, all but EDITS have to be equal, whatever their order: there
    is a trie for each such choice, with the others in every order.
    """
    if runs:
        yield from _run_links(names)
        return
    tries: dict[str | None, Trie] = {}
    for side, core, word, rest in names:
        if side != 0:
            words = rest.split(" ")
            if len(words) > 3:
                tries.setdefault(None, Trie()).add(rest, (core, word))
                for equal, others in _apart(words):
                    for p in set(permutations(others)):
                        tries.setdefault(equal, Trie()).add(" ".join(p), (core, word))
            else:
                for p in set(permutations(words)):
                    tries.setdefault(None, Trie()).add(" ".join(p), (core, word))
    for side, core, word, rest in names:
        if side == 1:
            continue
        most = allowed(len(core.replace(" ", "")))
        words = rest.split(" ")
        walks = [(None, rest)] + ([(equal, " ".join(others)) for equal, others in _apart(words)] if len(words) > 3 else [])
        for key, text in walks:
            for (other, w), n in tries[key].within(text, most if rest else 0) if key in tries else ():
                if other != core and n + (0 if w == word else osa(w, word, most)) <= most:
                    yield (core, other) if core < other else (other, core)


def _run_links(names: list[tuple[int, str, str, str]]) -> Iterator[tuple[str, str]]:
    """Links of a shard of equal letters: names run together with those of many words."""
    for side, core, *_ in names:
        for other_side, other, *_ in names:
            if side != 1 and other_side != 0 and core != other and (" " in core) != (" " in other):
                words, run = (core, other) if " " in core else (other, core)
                if reordered(words.split(" "), run, allowed(len(run))):
                    yield (core, other) if core < other else (other, core)


def _links(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Streams rows sorted by shard and blocks; a shard may span batches."""
    key, names = None, []
    for pdf in batches:
        found: set[tuple[str, str]] = set()
        for k, side, core, word, rest in zip(zip(pdf["shard"], pdf["left"], pdf["right"]), pdf["side"], pdf["core"], pdf["word"], pdf["rest"]):
            if k != key:
                found.update(_shard_links(names, key is not None and key[0][0] == "a"))
                key, names = k, []
            names.append((side, core, word, rest))
        yield pd.DataFrame(sorted(found), columns=["a", "b"])
    yield pd.DataFrame(sorted(set(_shard_links(names, key is not None and key[0][0] == "a"))), columns=["a", "b"])


def core_links(cores: DataFrame) -> DataFrame:
    """a < b of cores (column core) within the bounded edits of each other, their words in any order."""
    sharded = stage(cores.select("core").mapInPandas(_shards, "shard string, core string, word string, rest string"), "shards")
    sizes = sharded.groupBy("shard").agg(F.count("*").alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    held = sharded.join(sizes.withColumn("blocks", blocks), "shard").withColumn("own", F.pmod(F.xxhash64("core"), "blocks").cast("int"))
    # A name of block i is on the left of pairs (i, j >= i) and on the right of pairs (j < i, i); in (i, i) on both.
    pair = F.explode(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: F.struct(F.least("own", j).alias("left"), F.greatest("own", j).alias("right"), F.when(F.col("own") == j, 2).when(F.col("own") < j, 0).otherwise(1).alias("side"))))
    rows = held.select("shard", "core", "word", "rest", pair.alias("p")).select("shard", "core", "word", "rest", "p.*")
    # A number given, so that small rows which take long are not put together in one task.
    tasks = max(int(cores.sparkSession.conf.get("spark.sql.shuffle.partitions")), cores.sparkSession.sparkContext.defaultParallelism)
    rows = rows.repartition(tasks, "shard", "left", "right").sortWithinPartitions("shard", "left", "right")
    return rows.mapInPandas(_links, "a string, b string").distinct()


def representatives(cores: DataFrame, links: DataFrame) -> DataFrame:
    """core, org: each core points to its best-supported neighbour, if better than itself; pointers are then followed.

    cores: core, n (rows). Ties go to the smaller string. A pointer only leads to a better core, so none is a circle;
    each round halves the way, until nothing changes.
    """
    both = links.select(F.col("a").alias("core"), F.col("b").alias("other")).union(links.select("b", "a"))
    rank = cores.select(F.col("core").alias("other"), F.struct((-F.col("n")).alias("n"), F.col("core").alias("c")).alias("rank"))
    best = both.join(rank, "other").groupBy("core").agg(F.min("rank").alias("rank"))
    own = cores.join(best, "core", "left").withColumn("mine", F.struct((-F.col("n")).alias("n"), F.col("core").alias("c")))
    at = stage(own.select("core", F.when(F.col("rank") < F.col("mine"), F.col("rank.c")).otherwise(F.col("core")).alias("org")), "org")
    while True:
        nxt = at.join(at.select(F.col("core").alias("org"), F.col("org").alias("further")), "org").select("core", F.col("further").alias("org"), (F.col("further") != F.col("org")).alias("moved"))
        done = at
        at = stage(nxt, "org")
        unstage(done)
        if at.where("moved").isEmpty():
            return at.select("core", "org")


_PARSED = "name string, n bigint, core string, full_word string, part string, first boolean, kind string"


def _parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = []
        for name, n in zip(pdf["name"], pdf["n"]):
            words, cut = words_of(name)
            short = [i for i, (w, c) in enumerate(zip(words, cut)) if c or len(w) == 1]
            if not words:
                continue
            if short and len(words) == 2 and len(short) == 1:
                i = short[0]
                rows.append((name, n, None, words[1 - i], words[i], i == 0, "short"))
            elif len(words) == 1 and len(words[0]) < 14 and not short and len(re.sub(r"[^a-z]", "", plain(name))) == len(words[0]):
                rows.append((name, n, words[0], words[0], None, None, "single"))
            else:
                rows.append((name, n, " ".join(words), None, None, None, "full"))
        yield pd.DataFrame(rows, columns=["name", "n", "core", "full_word", "part", "first", "kind"])


def organisations(deals: DataFrame, aliases: DataFrame) -> DataFrame:
    """name, org: each different spelling in target or acquirer and the core of the organisation it names.

    Spellings that name none (empty, placeholders) and those that could name several organisations stand alone and are
    left out. Nulls name none; a spelling counts its rows, repeated ones too.
    """
    spelled = deals.select(F.explode(F.array("target", "acquirer")).alias("name")).where("name is not null").groupBy("name").agg(F.count("*").alias("n"))
    known = aliases.where("canonical is not null and variant is not null")
    extra = known.select(F.explode(F.array("canonical", "variant")).alias("name")).distinct().join(spelled, "name", "left_anti").withColumn("n", F.lit(0).cast("long"))
    parsed = stage(spelled.unionByName(extra).mapInPandas(_parse, _PARSED), "names")
    full = parsed.where("kind <> 'short'")
    cores = stage(full.groupBy("core").agg(F.sum("n").alias("n"), F.max(F.col("kind") == "full").alias("is_full")), "cores")
    typos = core_links(cores.where("is_full"))
    typos = stage(typos, "links")
    org = representatives(cores.where("is_full").select("core", "n"), typos)

    by_name = stage(full.where("kind = 'full'").join(org, "core").select("name", "org", "core"), "named")
    # Other known names go to the organisation of their canonical name.
    canon = known.join(by_name.select(F.col("name").alias("canonical"), "org"), "canonical").select("variant", "org")
    canon = canon.groupBy("variant").agg(F.min("org").alias("org"), F.max("org").alias("most")).where("org = most").select(F.col("variant").alias("name"), "org")
    # The words of an organisation, from all its cores of two words or more.
    words = org.select("org", F.split("core", " ").alias("w")).where(F.size("w") >= 2)
    words = stage(words.select("org", F.col("w")[0].alias("w0"), F.col("w")[1].alias("w1")).distinct(), "words")
    firsts = words.groupBy(F.col("w0").alias("full_word")).agg(F.min("org").alias("org"), F.max("org").alias("most")).where("org = most").select("full_word", "org")
    short = parsed.where("kind = 'short'")
    sides = words.select("org", F.col("w1").alias("full_word"), F.col("w0").alias("other"), F.lit(True).alias("first")).union(words.select("org", "w0", "w1", F.lit(False)))
    fits = short.join(sides, ["full_word", "first"]).where(F.expr("startswith(other, part)")).groupBy("name").agg(F.min("org").alias("org"), F.max("org").alias("most"))
    fits = fits.where("org = most").select("name", "org")
    single = parsed.where("kind = 'single'").select("name", "n", "full_word", "core")
    alone = single.join(firsts, "full_word").select("name", "org")
    run = single.join(typos_of_runs(single, org), "core").select("name", "org")
    # Single words that begin or make up no organisation's name are names of their own, with their own typos.
    begun = words.select(F.col("w0").alias("full_word")).union(org.select(F.replace("core", F.lit(" "), F.lit(""))))
    own = stage(single.join(begun, "full_word", "left_anti"), "singles")
    lone = own.groupBy("core").agg(F.sum("n").alias("n"))
    lone = own.join(representatives(lone, stage(core_links(lone), "links")), "core").select("name", F.concat(F.lit("1:"), "org").alias("org"))
    every = [(canon, 0), (by_name.select("name", "org"), 1), (run, 2), (fits, 3), (alone, 4), (lone, 5)]
    pool = None
    for df, rank in every:
        df = df.withColumn("rank", F.lit(rank))
        pool = df if pool is None else pool.unionByName(df)
    return pool.groupBy("name").agg(F.min_by("org", F.struct("rank", "org")).alias("org")).join(spelled.select("name"), "name", "left_semi")


def typos_of_runs(single: DataFrame, org: DataFrame) -> DataFrame:
    """core, org of single words that are a whole name run together."""
    runs = org.select("org", F.replace("core", F.lit(" "), F.lit("")).alias("core")).where("instr(core, ' ') = 0")
    return runs.groupBy("core").agg(F.min("org").alias("org"), F.max("org").alias("most")).where("org = most").select("core", "org").join(single.select("core").distinct(), "core", "left_semi")


def variant_pairs(deals: DataFrame, aliases: DataFrame) -> DataFrame:
    """name_a < name_b of different spellings that name one organisation. Each spelling counts once, so hot names are one row."""
    org = stage(organisations(deals, aliases), "organisations")
    a, b = org.select("org", F.col("name").alias("name_a")), org.select("org", F.col("name").alias("name_b"))
    return a.join(b, "org").where("name_a < name_b").select("name_a", "name_b")
