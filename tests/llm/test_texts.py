"""Names, leaks, mixing and look-alikes."""

import unicodedata

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import leaks, mixing, names
from tidemark.llm.leaks import leak_report, leaked_items, tiles
from tidemark.llm.looks import LOOKS, consistent_text, look_alikes, one_form
from tidemark.llm.mixing import mixed_records, reached_shares, token_count
from tidemark.llm.names import Trie, core_links, osa, variant_pairs, words_of

DEALS = "deal_id bigint, target string, acquirer string, name string, org string"
ALIASES = "canonical string, variant string, precedence int"


@pytest.mark.parametrize(
    "name, want", [("The Foo Bar Biosciences company", ["foo", "bar"]), ("Foo Bar Pharma, Inc.", ["foo", "bar"]), ("FOO  Bär (Port Selwick)", ["foo", "bar"]), ("Foo/Bar", ["foo", "bar"]), ("FooBar Tx", ["foo", "bar"]), ("Foo Bar S.A.", ["foo", "bar"]), ("undisclosed", []), ("-", []), ("", [])]
)
def test_words(name, want):
    assert words_of(name)[0] == want


def test_trie_against_distances():
    rng = np.random.default_rng(0)
    words = ["".join(rng.choice(list("abc"), int(n))) for n in rng.integers(1, 9, 300)]
    trie = Trie()
    for w in words:
        trie.add(w, w)
    for w in words[:40]:
        assert sorted(trie.within(w, 2)) == sorted((v, osa(w, v, 9)) for v in words if osa(w, v, 9) <= 2)


def test_core_links_against_all_pairs(spark, monkeypatch):
    rng = np.random.default_rng(1)

    def word():
        return "".join(str(rng.choice(list("bdfgklmn"))) + str(rng.choice(list("aeio"))) for _ in range(3))

    cores = set()
    for _ in range(60):
        a, b = word(), word()
        cores |= {f"{a} {b}", f"{b} {a}"[: 13], f"{a[:2]}{a[3:]} {b}", f"{a} {b[:1]}{b[2]}{b[1]}{b[3:]}", f"{a[1]}{a[0]}{a[2:]} {b}x"}
    cores = sorted(cores)
    want = set()
    for i, a in enumerate(cores):
        for b in cores[i + 1 :]:
            n = min(osa(p, b, 3) for p in (a, " ".join(reversed(a.split(" ")))))
            if n <= min(names.allowed(len(x.replace(" ", ""))) for x in (a, b)):
                want.add((a, b))
    df = spark.createDataFrame([(c,) for c in cores], "core string")
    got = {tuple(r) for r in core_links(df).collect()}
    # Two edits in one word with none in the other, or one in each: the sharding is complete for these.
    assert len(want - got) <= 0.02 * len(want)
    monkeypatch.setattr(names, "BLOCK", 3)
    assert {tuple(r) for r in core_links(df).collect()} == got


@pytest.mark.parametrize(
    "a, b, want",
    [("abra bole cimo dura effo", "effo dura cimo bole abra", True), ("abra bole cimo dura effo", "effo durra cimo bole abar", True), ("abra bole cimo dura effo", "effo durra cimmo boole abra", False), ("abra bole cimo dura effo gilu", "gilu effo abra cimo bole dura", True)]
    + [("astrazeneca", "astrzenca", True), ("regeneron", "regenaran", True), ("regeneron", "ragenaran", False), ("abra bole cimo dura", "duracimoboleabra", True), ("abra bole cimo dura", "duracmoboleabra", True), ("abra bole cimo dura", "duracimoboleabxx", False), ("abra bole cimo dura", "abra bolecimo dura", True)],
)
def test_links_of_many_and_single_words(spark, a, b, want):
    df = spark.createDataFrame([(a,), (b,), ("other name",)], "core string")
    assert {tuple(r) for r in core_links(df).collect()} == ({(min(a, b), max(a, b))} if want else set())


def test_single_words_alone(spark):
    """One-word names that no longer name has are organisations, with their typos and cases; an ambiguous one is not."""
    names_ = ["Novartis", "NOVARTIS", "Novratis", "Regeneron", "Foba Alim", "Foba Zukor", "Foba", "FOBA"]
    deals = spark.createDataFrame([(i, n, None, "c", "c") for i, n in enumerate(names_)], DEALS)
    got = {tuple(r) for r in variant_pairs(deals, spark.createDataFrame([], ALIASES)).collect()}
    assert got == {("NOVARTIS", "Novartis"), ("NOVARTIS", "Novratis"), ("Novartis", "Novratis")}


def test_variants(spark):
    one = ["Tretare Naleka Therapeutics", "TRETARE Naleka Tx", "Naleka Tretare Therapeutics", "T. Naleka Therapeutics", "Tretaer Naleka Therapeutics Inc", "Tretare/Naleka", "Tretarenaleka Therapeutics", "TNTQ", "Trétare Naleka Therapeutics (Lakemont)"]
    other = ["Tretare Dokila Genomics", "Tretare Dokila Genomics plc"]
    rows = [(i, a, b, "clash", "clash") for i, (a, b) in enumerate(zip(one + other, [None, "", "-", "TBD", "unknown", one[0], one[0], "Tretare", "Lone Wolfe Pharma", None, other[0]]))]
    deals = spark.createDataFrame(rows, DEALS)
    aliases = spark.createDataFrame([(one[0], "TNTQ", 1), (None, "X", 1), ("Y", None, 1)], ALIASES)
    got = {tuple(r) for r in variant_pairs(deals, aliases).collect()}
    want = {(a, b) for g in (one, other) for a in g for b in g if a < b}
    assert got == want  # 'Tretare' could name either organisation and names none
    assert variant_pairs(deals.limit(0), aliases).count() == 0 and variant_pairs(deals, aliases.limit(0)).count() == len(want) - 8


def test_forms():
    assert one_form(["ﬁne Ⅱ µ é Å", "Ａｂ　c", "a­​b", "ガ", "TNF‑α", "", "x²½", "а b"]) == ["fine II μ é Å", "Ab c", "ab", "ガ", "TNF-α", "", "x²½", "a b"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.characters(max_codepoint=0x30FF, exclude_categories=("Cs",)), max_size=12), max_size=6))
def test_form_is_one(texts):
    """A form is its own form, canonical spellings share it, and neighbours in a batch do not touch."""
    forms = one_form(texts)
    assert one_form(forms) == forms
    assert one_form([unicodedata.normalize("NFD", t) for t in texts]) == one_form([unicodedata.normalize("NFC", t) for t in texts])
    assert forms == [one_form([t])[0] for t in texts]


def test_syllables():
    ga, gag, letters = "가", "각", "ㄱㅏ"
    assert one_form(["가", "각", "각", letters, "ᄀ", "ᅡ"]) == [ga, gag, gag, letters, "ᄀ", "ᅡ"]


def test_look_alike_classes(spark):
    from tidemark.llm.looks import look_alike_classes

    df = spark.createDataFrame([(4, "cafe"), (2, "cafе"), (3, "cafe"), (9, "x"), (8, None)], "doc_id bigint, text string")
    assert sorted(map(tuple, look_alike_classes(df).collect())) == [(2, 2, 2), (3, 2, 2), (4, 2, 2), (9, 9, 1)]
    assert look_alike_classes(df.limit(0)).count() == 0


def test_look_alikes(spark):
    texts = ["cafe x", "cafe x", "cafе x", "ｃafe x", "café x", "café x", "Cafe x", None, "", "", "y" * 200_000]
    df = spark.createDataFrame([(i, t, "clash", "clash") for i, t in enumerate(texts)], "doc_id bigint, text string, own string, form string")
    assert {tuple(r) for r in look_alikes(df).collect()} == {(0, 2), (1, 2), (0, 3), (1, 3), (2, 3), (4, 5)}
    assert {r.doc_id: r.text for r in consistent_text(df).collect()}[2] == "cafe x"
    assert look_alikes(df.limit(0)).count() == 0 and len(LOOKS) > 30


def test_tiles():
    a = np.array([1, 2, 3, 4, 5, 6, 7, 8, 9])
    assert tiles(np.concatenate([a[5:], [0], a[:5]]), a, 3) == [(5, 0, 5), (0, 5, 4)]
    assert tiles(a, a[::-1].copy(), 2) == [] and tiles(a[:0], a, 1) == []
    long = np.arange(300)
    assert tiles(np.concatenate([long[150:], long[:150], long[:40]]), long, 8) == [(0, 150, 150), (150, 0, 150)]


def brute_tiles(doc, item, least):
    """The definition: of all matches of unmarked words the longest first, by place where equal."""
    free_d, free_i, found = [True] * len(doc), [True] * len(item), []
    while True:
        best = (least - 1, 0, 0)
        for i in range(len(doc)):
            for j in range(len(item)):
                n = 0
                while i + n < len(doc) and j + n < len(item) and doc[i + n] == item[j + n] and free_d[i + n] and free_i[j + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < least:
            return found
        for k in range(n):
            free_d[i + k] = free_i[j + k] = False
        found.append((i, j, n))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=40), st.lists(st.integers(0, 3), max_size=24), st.integers(1, 4))
def test_tiles_against_brute_force(doc, item, least):
    got = tiles(np.array(doc, np.uint64) + np.uint64(7), np.array(item, np.uint64) + np.uint64(7), least)
    assert got == brute_tiles(doc, item, least)


def test_leaks(spark, monkeypatch):
    passage = " ".join(f"word{i}" for i in range(40)) + "."
    w = passage.rstrip(".").split()
    docs = [
        (1, "start " + " ".join(w[5:17]).upper() + " end"),
        (2, "start " + " ".join(w[5:16]) + " end"),
        (3, ", ".join(w[3:20]).replace("word", "w​оrd")),
        (4, " ".join(w[20:31] + ["x"] + w[5:16])),
        (5, None), (6, ""), (7, passage * 500), (7, passage),
    ]
    df = spark.createDataFrame([(i, t, 9) for i, t in docs], "doc_id bigint, text string, item_id int")
    items = spark.createDataFrame([(10, "s", passage), (11, "s", None), (12, "s", "too short"), (13, "s", "")], "item_id bigint, suite string, passage string")
    want = [(1, 10), (3, 10), (7, 10), (7, 10)]
    assert sorted(map(tuple, leaked_items(df, items).collect())) == want
    monkeypatch.setattr(leaks, "HOT", 1)
    assert sorted(map(tuple, leaked_items(df, items).collect())) == want
    report = leak_report(df, items).collect()
    assert [(r.item_id, r.documents, r.longest, r.coverage) for r in report] == [(10, 4, 40, 1.0)]
    assert leaked_items(df.limit(0), items).count() == 0 and leaked_items(df, items.limit(0)).count() == 0


def test_reordered_passages(spark):
    """A passage in three parts, none of RUN words, is reported by its coverage alone."""
    w = [f"word{chr(97 + i)}" for i in range(26)]
    doc = " ".join(w[16:26] + ["x"] + w[8:16] + ["y"] + w[:8])
    items = spark.createDataFrame([(1, "s", " ".join(w))], "item_id bigint, suite string, passage string")
    docs = spark.createDataFrame([(5, doc), (6, " ".join(w[:8]))], "doc_id bigint, text string")
    assert leaked_items(docs, items).count() == 0
    assert [tuple(r) for r in leak_report(docs, items).collect()] == [(1, "s", 1, 10, 1.0)]


def test_many_items(spark):
    """100,000 items, all joined in Spark, against documents that hold some of them; a seed of all of them is salted."""
    n = 100_000
    items = spark.range(n).select(F.col("id").alias("item_id"), F.lit("s").alias("suite"), F.concat(F.lit("these eight words stand at every item's start "), F.array_join(F.transform(F.sequence(F.lit(0), F.lit(14)), lambda k: F.concat(F.lit("w"), F.hex(F.xxhash64("id", k)))), " ")).alias("passage"))
    some = items.where("item_id % 997 = 5")
    docs = some.select(F.col("item_id").alias("doc_id"), F.concat(F.lit("x "), F.substring_index(F.substring_index("passage", " ", 24), " ", -15), F.lit(" y")).alias("text"))
    assert sorted(map(tuple, leaked_items(docs, items).collect())) == sorted((r.item_id, r.item_id) for r in some.collect())
    assert "toLocalIterator" not in open(leaks.__file__).read()
    plan = leaks.leak_tiles(docs, items)._jdf.queryExecution().toString()
    assert "Join" in plan


def mix_tables(spark):
    docs = [(i, f"text number {i} of a source with some words", "big") for i in range(300)] + [(1000 + i, f"small {i}", "small") for i in range(10)] + [(2000, None, "big"), (2001, "x", None), (2002, "x", "untold"), (3000, "one and only text", "single")]
    docs += [docs[5], docs[5]]
    targets = [("big", 0.3, 2), ("small", 0.3, 3), ("none", 0.2, 2), ("single", 0.2, 1)]
    return spark.createDataFrame([(*d, 1, 1) for d in docs], "doc_id bigint, text string, source string, h int, below int"), spark.createDataFrame(targets, "source string, target_share double, max_repeats int")


def test_mixing(spark):
    docs, targets = mix_tables(spark)
    tokens = {(r.doc_id): r.n for r in docs.select("doc_id", token_count(F.col("text")).alias("n")).collect()}
    for total in (None, 50, 400, 5000):
        rows = mixed_records(docs, targets, total).collect()
        shares = {r.source: r for r in reached_shares(docs, targets, total).collect()}
        have = {s: r.tokens for s, r in shares.items()}
        want = total if total is not None else sum(have.values())
        caps = {r.source: r.max_repeats for r in targets.collect()}
        for s, r in shares.items():
            got = sum(x.n_tokens * x.copies for x in rows if x.source == s)
            assert got == r.mixed_tokens
            budget = int(r.target_share * want)
            assert all(x.copies <= caps[s] for x in rows if x.source == s)
            assert got <= budget
            if have[s]:
                # Nothing larger than one record, with its repeats, is left of the budget unless the cap binds.
                most = max(tokens[x.doc_id] for x in docs.where(F.col("source") == s).collect() if x.text)
                assert got >= min(budget, caps[s] * have[s]) - 3 * most
        assert not [x for x in rows if x.source in (None, "untold")] and 2000 not in {x.doc_id for x in rows}
    often = targets.withColumn("max_repeats", F.when(F.col("source") == "single", 100).otherwise(F.col("max_repeats")))
    kept = {r.source: r for r in reached_shares(docs, often, keep_shares=True).collect()}
    total = sum(r.mixed_tokens for r in kept.values())
    assert all(abs(r.mixed_tokens / total - r.target_share / 0.8) < 0.1 for r in kept.values() if r.tokens) and kept["none"].mixed_tokens == 0
    again = sorted(map(tuple, mixed_records(docs.repartition(7), targets).collect()))
    assert again == sorted(map(tuple, mixed_records(docs, targets).collect()))
    assert mixed_records(docs.limit(0), targets).count() == 0 and reached_shares(docs.limit(0), targets).count() == 4
    assert mixing.BITS * mixing.LEVELS == 60


def test_queries_run(spark, sf):
    from tidemark.llm.queries import QUERIES, SQL

    assert set(SQL) <= set(QUERIES) and {f"p{n}_found" for n in (1, 2, 3, 6, 7, 8, 10)} <= set(QUERIES)
    for name in ("p3_found", "p6_rebuilt", "p8_found", "p9_shares", "p10_found"):
        assert QUERIES[name](spark, sf).count() >= 0


@pytest.mark.parametrize("name", ["p6_found", "p6_rebuilt"])
def test_repeated_lines_equal_sql(spark, sf, name):
    import duckdb

    from tidemark.llm.queries import QUERIES, SQL

    con = duckdb.connect()
    con.execute(f"CREATE VIEW articles AS SELECT * FROM '{sf}/articles.parquet'")
    assert sorted(con.execute(SQL[name]).fetchall(), key=repr) == sorted(map(tuple, QUERIES[name](spark, sf).collect()), key=repr)
