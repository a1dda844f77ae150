"""Main body, residue, repeated lines and near copies of pages."""

import re
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.llm import near, residue
from tidemark.llm.furniture import Winners, furniture_lines, same_story, winners
from tidemark.llm.lines import Cut, digest, headline_like, line_scores, names_of, path_of, site_names, slot_paths
from tidemark.llm.near import gram_sets, near_copies, pairs_of_sets
from tidemark.llm.pages import main_body_lines, template_residue
from tidemark.llm.repeated import repeated_lines, without_repeated
from tidemark.llm.wordhash import grams, word_hashes

ART = "article_id bigint, url string, title string, content string, source string, error_message string, host string, path bigint"
BODY = [f"The {a} said that the {b} would {c} its plan for the {d} plant, and that {i} people in the town would keep their posts there." for i, (a, b, c, d) in enumerate((w, x, y, z) for w in ("board", "maker") for x in ("union", "owner", "city") for y in ("drop", "keep") for z in ("north", "south"))]


def own(i):
    """A word of its own for each page, without figures, which paths generalise."""
    return chr(97 + i % 26) * (2 + i // 26)


def pages(spark, extra=()):
    """Forty pages of two hosts, each with a story of its own between the host's furniture."""
    rows = []
    for i in range(40):
        host = ("www.left-paper.org", "www.right-paper.org")[i % 2]
        top = ("Weather | Traffic | Sports", "Our pages: all news, all day")[i % 2]
        story = "\n".join(BODY[(i + k) % len(BODY)].replace("town", f"{own(i)}ton") for k in (0, 5, 11))
        end = ("Left Paper is printed on old paper.", "Ask Right Paper a question")[i % 2]
        rows.append((i, f"https://{host}/a/{i}", f"Plan number {i} of the board", f"{top}\n\nPlan number {i} of the board\n{story}\n{end}", ("Left Paper", "Right Paper")[i % 2], None, "clash", 0))
    return spark.createDataFrame(rows + list(extra), ART)


def test_paths():
    names = site_names("Left Paper", "www.left-paper.org")
    assert path_of("  JOIN 14,000 Readers of  LEFT paper ", names) == "join 0,0 readers of {s}"
    assert slot_paths("By Ann Other for Left Paper", names) == ["by {n} for {n}"] and slot_paths("Ann Other | Senior Reporter", names)[:2] == ["ann other > {*}", "{*} | senior reporter"]
    assert slot_paths("BY ANN OTHER", names) == ["by {n}"] and slot_paths("WRITTEN BY ANN OTHER, STAFF WRITER", names)[1] == "written by {n}, {n}"
    assert slot_paths("Tags: a, b", names) == ["tags: {*}"] and slot_paths("Home > News > Mills", names)[0] == "home > {*}" and slot_paths("A crowded field", names) == []
    assert slot_paths("Other covers mills from Lee. Reach the desk on extension 33.", names) == ["{*} reach the desk on extension 0."]
    cut = Cut([("T", " Join  14 of LEFT Paper\n\nno", names), (None, "join 9,9 of left-paper", names), (None, None, names)])
    assert cut.lines == ["T", "Join 14 of LEFT Paper", "", "no", "", "join 9,9 of left-paper", ""] and cut.starts == [0, 4, 6, 7]
    assert cut.digests[1] == Cut([("join 7 of {s}", "", [])]).digests[0] and cut.digests[5] != cut.digests[1] and cut.filled.tolist() == [True, True, False, True, False, True, False]
    assert headline_like("Alpha buys Beta Pharma") and not headline_like("Terms at a glance") and not headline_like("It is so.")


def test_votes_find_furniture(spark):
    got = Counter()
    for r in furniture_lines(pages(spark)).collect():
        got[r.line_no] += 1
    assert got == {1: 40, 7: 40}


def copies(n):
    """Copies of one story on both hosts of pages(), each with an edit of its own: a third of the hosts' rows."""
    story = ["Reaction in the valley", "- The union keeps its seat", "“We had hoped for more,” said Ann Valdor.", "Valdor Mills will close in May, the owner said, and the 40 people who work at Valdor will be paid until August."]
    rows = []
    for i in range(n):
        host = ("www.left-paper.org", "www.right-paper.org")[i % 2]
        top, end = (("Weather | Traffic | Sports", "Left Paper is printed on old paper."), ("Our pages: all news, all day", "Ask Right Paper a question"))[i % 2]
        title = ("Owner shuts Valdor Mills", "Update: owner shuts Valdor Mills", f"Owner shuts Valdor Mills, tells {i}")[i % 3]
        text = [x for k, x in enumerate(story) if k != i % 7] + [BODY[i % len(BODY)].replace("town", f"{own(i)}ville")]
        rows.append((100 + i, f"https://{host}/c/{i}", title, "\n".join([top, title, *text, end]), ("Left Paper", "Right Paper")[i % 2], None, "clash", 0))
    return rows


def test_a_story_votes_once_a_host(spark):
    rows = copies(20)
    got = Counter()
    for r in furniture_lines(pages(spark, rows)).collect():
        got[r.article_id] += 1
    assert got == dict.fromkeys([*range(40), *(r[0] for r in rows)], 2)
    last = {r[0]: len(r[3].split("\n")) for r in rows}
    found = {tuple(r) for r in furniture_lines(pages(spark, rows)).collect()}
    assert all((i, 1) in found and (i, n) in found for i, n in last.items())


def test_long_notices_are_voted_on(spark):
    """A notice of one long line is furniture, at a page's end and amid its story; long paragraphs of the story stay."""
    notice = "This paper and its partners keep small files on your device, " + "which tell them what you read and for how long, " * 5 + "unless you say no."
    rows = []
    for r in pages(spark).collect():
        lines = r.content.split("\n")
        para = f"In {own(r.article_id)}ton, " + "where the plant has stood for years and years, " * 6 + "nobody knew."
        rows.append((*r[:3], "\n".join([*lines[:4], notice, para, *lines[4:], notice]), *r[4:]))
    assert len(notice) > 240
    got = Counter(r.line_no for r in furniture_lines(spark.createDataFrame(rows, ART)).collect())
    assert got == {1: 40, 5: 40, 9: 40, 10: 40}


LINES = ["This press text was supplied by a third party, who alone answers for its content.", "Send by mail · Copy link · Save for later", "By Ann Other", "Tags: mills, towns", "Related: Alpha buys Beta", "Related stories", "© 2020 Left Paper"]


@pytest.mark.parametrize("line", LINES)
def test_no_line_is_furniture_without_votes(line):
    """A page that no other page resembles keeps its lines; with the path's votes they go."""
    names = site_names("Left Paper", "www.left-paper.org")
    won = {int(Cut([(line, "", names)]).digests[0]): False}
    assert Winners({}, {}).marks("www.left-paper.org", "Left Paper", None, line, {})[1] == [False]
    assert Winners({}, {}).marks("www.left-paper.org", "Left Paper", None, line, won)[1] == [True]
    for p in slot_paths(line, names):
        assert Winners({}, {digest(p): False}).marks("www.left-paper.org", "Left Paper", None, line, {})[1] == [True]


def test_votes_with_slots(spark):
    """Bylines, labels and notes that differ on each page win by their slots; without the votes nothing is marked."""
    rows = []
    for r in pages(spark).collect():
        k = r.article_id
        name = f"{chr(65 + k % 26)}ora {chr(65 + k // 2)}eltan"
        lines = r.content.split("\n")
        rows.append((*r[:3], "\n".join([*lines[:3], f"By {name}", *lines[3:], f"Topics: mill{'s' * k}, towns", f"{name.split()[1]} covers mill{'s' * k}. Reach the desk on extension {k}."]), *r[4:]))
    df = spark.createDataFrame(rows, ART)
    got = Counter(r.line_no for r in furniture_lines(df).collect())
    assert got == {1: 40, 4: 40, 8: 40, 9: 40, 10: 40}
    assert not any(any(Winners({}, {}).marks("h", r.source, r.title, r.content, {})[1]) for r in df.collect())


def test_sentences_win_on_hosts_together(spark):
    """A note on few pages of each host wins by all hosts; a paragraph that many copies of one story share never does."""
    note = "Correction: an earlier version of this page gave a wrong date."
    shared = "The mill in Valdor will close in May, said its owner, and nobody knows what comes after that day."
    rows = []
    for i in range(480):
        host = f"www.h{i % 12}-paper.org"
        story = [BODY[(i + k) % len(BODY)].replace("town", f"{own(i)}ton") for k in (0, 5)]
        title = "Owner shuts Valdor Mills" if i % 40 < 6 else f"Plan N{i}x of the board"
        rows.append((i, f"https://{host}/{i}", title, "\n".join([*story, *([shared, "Valdor Mills"] if i % 40 < 6 else []), *([note] if i % 24 > 21 else [])]), f"H{i % 12}", None, "", 0))
    got = Counter(r.article_id for r in furniture_lines(spark.createDataFrame(rows, ART)).collect())
    assert got == {i: 1 for i in range(480) if i % 24 > 21}


def test_line_scores():
    long = "The owner said that the mill would close in May and that all would be paid."
    cut = Cut([(None, "\n".join(("Home | News", long, long, "Rivals", "- The union keeps its seat", "", long, "Home")), [])])
    at, page, score = cut.body()
    assert cut.prose[at].tolist() == [0, 4, 4, 0, 2, 4, 0] and set(page) == {0}
    assert score.tolist() == [16, 10, 10, 16, 13, 13, 16]
    assert line_scores(np.array([4, 4, 4]), np.zeros(3)).tolist() == [10, 4, 10] and line_scores(np.array([4, 4, 4]), np.array([0, 0, 1])).tolist() == [10, 10, 16]


def test_names_of():
    assert names_of("Gout: Foba Pharma heads for Phase II") == {"foba", "foba pharma", "phase", "phase ii"}


@pytest.mark.parametrize(
    "line, title, want",
    [("X-12 meets goal in Phase 2 gout trial", "Y-9 meets goal in Phase 2 gout trial", False), ("Regulators clear X-12 for gout", "Regulators clear Y-9 for gout", False), ("Gout: Foba Pharma heads for Phase II", "Asthma: Zati Pharma heads for Phase II", False)]
    + [("Alpha buys Beta", "Exclusive: Alpha buys Beta", True), ("Foba Pharma to by Zati Bio", "Foba Pharma to buy Zati Bio", True), ("Regulators clear X-12 in gout", "Regulators clear X-12 for gout", True), ("Alpha buys Beta", None, False)],
)
def test_own_headline(line, title, want):
    assert same_story(line, title, []) is want


def test_null_blank_and_empty(spark):
    extra = [(90, None, None, None, None, None, "", 0), (91, "https://www.left-paper.org/9", None, "  \n \n", "Left Paper", None, "", 0), (92, "no url", "", "x" * 100_000, None, None, "", 0)]
    df = pages(spark, extra)
    assert {r.article_id for r in main_body_lines(df).collect()} == set(range(40))
    for op in (main_body_lines, template_residue, near_copies, repeated_lines, without_repeated):
        assert op(df.limit(0)).count() == 0


def test_paths_joined_when_too_many_to_send(spark, monkeypatch):
    from tidemark.llm import furniture

    want = sorted(map(tuple, furniture_lines(pages(spark)).collect()))
    monkeypatch.setattr(furniture, "SENT_PATHS", 0)
    assert winners(pages(spark))[1] is not None
    assert sorted(map(tuple, furniture_lines(pages(spark)).collect())) == want


def test_list_of_other_stories():
    w = Winners({}, {int(Cut([("related stories", "", [])]).digests[0]): True})
    lines = ["Alpha buys Beta", "One said that it is so and that it will be so for a long time to come.", "Related stories", "Gamma Pharma buys Delta Bio", "Five questions on X-12 for Ann", "A crowded field", "Two said it, too."]
    assert w.marks("h.org", None, "Alpha buys Beta", "\n".join(lines), {})[1] == [False, False, True, True, True, False, False]


@pytest.mark.parametrize(
    "text, want",
    [("Hello {{ name }}", True), ("pay ${amount} now", True), ("by [INSERT QUOTE]", True), ("%(who)s said", True), ("<%= body %>", True), ("for undefined granted", True), ("{0} of 5", True), ("__DATE__", True), ("%HEADLINE%", True)]
    + [("“[The drug] is safe,”", False), ("a field left undefined counts as 3", False), ("undefined behaviour guard", False), ("a form with [name of patient] went", False), ("maps [22, 3761] to", False), ("up 5% of", False)],
)
def test_placeholders(text, want):
    assert residue.has_placeholder(text) is want


def test_residue(spark):
    extra = [
        (50, "https://www.left-paper.org/50", "404 Not Found", "Weather | Traffic | Sports\n404 Not Found\nRequest id: 12ab", "Left Paper", None, "", 0),
        (51, "https://www.left-paper.org/51", "t", "Lorem ipsum dolor sit amet, nulla ipsum amet elit duis quis commodo.", "Left Paper", "{{ error }}", "", 0),
        (52, "https://www.left-paper.org/52", "t", BODY[0] + "\nThe {{company}} said so.\n" + BODY[1], "Left Paper", "timeout after 5 s", "", 0),
        (53, "https://www.right-paper.org/53", "t", "Please enable JavaScript to continue using this page.", "Right Paper", "undefined", "", 0),
        (54, "https://www.right-paper.org/54", "t", BODY[0] + " “Access denied,” the portal told 9 users on May 1.\n" + BODY[2] + "\nPlease enable JavaScript to view the comments.", "Right Paper", "HTTP 404 while fetching, url dropped from batch 3", "", 0),
        (51, "https://www.left-paper.org/51", "t", "Lorem ipsum dolor sit amet, nulla ipsum amet elit duis quis commodo.", "Left Paper", None, "", 0),
    ]
    df = pages(spark, extra)
    got = sorted((r.article_id, r.field_name) for r in template_residue(df).collect())
    assert got == [(50, "content"), (51, "content"), (51, "content"), (51, "error_message"), (52, "content"), (53, "content"), (53, "error_message")]
    assert not {50, 51, 52, 53} & {r.article_id for r in main_body_lines(df).collect()}


#: Pages written by hand, labelled by reading: (title, lines, is it residue?).
BY_HAND = [
    ("Page not found", ["The page you asked for does not exist.", "Error 404"], True),
    ("503 Service Unavailable", ["503 Service Unavailable", "Please try again later."], True),
    ("Access denied", ["Access denied", "You do not have permission to view this page."], True),
    ("t", ["Lorem ipsum dolor sit amet, consectetur adipiscing elit, sed do eiusmod tempor."], True),
    ("t", ["Please enable JavaScript to view this page."], True),
    ("Mill shuts", BODY[:4], False),
    ("Outage at registry", [BODY[0], "For 9 hours the registry said that access was denied, and its staff wrote to 40 people.", BODY[3], BODY[5]], False),
    ("Site down", ["Page not found was all that 300 readers of the town paper saw on May 4, its owner said, after a cable had been cut by a digger near the plant.", BODY[1], BODY[2]], False),
]


def test_classifier_on_unseen_hosts(spark):
    """Fitted and tuned on half of the hosts, with no phrase or placeholder looked at, it tells the cases of the others and pages labelled by hand."""
    df = spark.read.parquet("/root/testdata/sf0.1/articles.parquet")
    won, each = winners(df)
    from tidemark.llm.furniture import pages_with_paths

    pages_ = pages_with_paths(df, each).toPandas()
    seen = pages_["host"].map(lambda h: digest(f"half{h}") % 2 == 0)
    model = residue.fit_field(residue.Values(pages_[seen], won), "content")
    rest = residue.Values(pages_[~seen], won)
    at = rest.of("content")
    y = np.array([residue.weak_label("content", rest.texts[i], rest.lines[i]) for i in at])
    found = model.score(*rest.features(at), len(at)) > model.threshold
    assert y.sum() >= 30 and (found & (y == 1)).sum() >= 0.95 * max(y.sum(), found.sum())
    p = model.score(*residue.features(["\n".join(x[1]) for x in BY_HAND], [x[0] for x in BY_HAND]), len(BY_HAND))
    assert ((p > model.threshold) == [x[2] for x in BY_HAND]).sum() >= len(BY_HAND) - 1


def brute_sets(texts):
    out = []
    for t in texts:
        w = re.findall(r"[^\W_]+", t.lower())
        out.append({tuple(w[i : i + 3]) for i in range(len(w) - 2)})
    return out


def test_word_hashes():
    texts = ["One two, TWO-three", "", "x_y é1 ½", "one"]
    h, at = word_hashes(texts)
    assert at.tolist() == [0, 0, 0, 0, 2, 2, 2, 2, 3] and h[0] == h[8] and h[1] == h[2]
    g, ga = grams(h, at, 3)
    assert ga.tolist() == [0, 0, 2, 2]


def edited(rng, words, share):
    out = list(words)
    for _ in range(int(len(words) * share)):
        i = int(rng.integers(len(out)))
        out[i] = f"w{int(rng.integers(5000))}"
    return out


def test_pairs_against_brute_force(spark):
    """Random texts over few words, with copies edited to every degree, small ones and exact repeats."""
    rng = np.random.default_rng(3)
    texts = []
    for _ in range(60):
        base = [f"w{int(x)}" for x in rng.zipf(1.6, int(rng.integers(3, 160))) % 300]
        texts.append(base)
        for _ in range(int(rng.integers(0, 4))):
            texts.append(edited(rng, base, rng.uniform(0, 0.3)))
        if rng.random() < 0.3:
            texts.append(base)
    texts = [" ".join(t) for t in texts] + ["a b", "", "c d e", "c d e"]
    sets = brute_sets(texts)
    want = {(i, j) for i in range(len(sets)) for j in range(i + 1, len(sets)) if sets[i] and sets[j] and 2 * len(sets[i] & sets[j]) > len(sets[i] | sets[j])}
    pdf = gram_sets(list(range(len(texts))), texts)
    df = spark.createDataFrame(pdf, near._SETS).repartition(3)
    got = [tuple(r) for r in pairs_of_sets(df).collect()]
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 40


def random_copies(seed, n, words=120, most=0.3):
    rng = np.random.default_rng(seed)
    base = [f"w{int(x)}" for x in rng.integers(0, 400, words)]
    return [" ".join(edited(rng, base, s)) for s in np.linspace(0, most, n)]


def test_pairs_cut_into_blocks_and_turns(spark, monkeypatch):
    """More classes, classes cut into blocks of rows, events in turns, and ids joined instead of sent give the same pairs."""
    df = spark.createDataFrame(gram_sets(list(range(25)), random_copies(4, 25)), near._SETS)
    want = sorted(map(tuple, pairs_of_sets(df).collect()))
    assert want
    monkeypatch.setattr(near, "_HELD", 50)
    monkeypatch.setattr(near, "_EVENTS", 20)
    assert sorted(map(tuple, pairs_of_sets(df).collect())) == want
    monkeypatch.setattr(near, "POSTINGS", 40)
    assert near.cut_of(25 * 118)[0] == 64 and near.cut_of(2 * 64 * 200)[1] == 10
    assert sorted(map(tuple, pairs_of_sets(df).collect())) == want
    monkeypatch.setattr(near, "POSTINGS", 4)
    monkeypatch.setattr(near, "SENT_IDS", 0)
    assert sorted(map(tuple, pairs_of_sets(df).collect())) == want


def test_candidates_alike_however_cut(spark, monkeypatch):
    """Blocks let through the candidates of uncut classes and no others; the further orders reject candidates and no case."""
    rng = np.random.default_rng(8)
    parts = [" ".join(f"w{int(x)}" for x in rng.integers(0, 4000, 30)) for _ in range(40)]
    texts = [" ".join(parts[int(k)] for k in rng.choice(40, 4, replace=False)) for _ in range(150)] + random_copies(5, 20)
    sets = spark.createDataFrame(gram_sets(list(range(len(texts))), texts), near._SETS).cache()
    total = sets.agg(F.sum("n")).first()[0]
    sketch = spark.sparkContext.broadcast(near.frequency_sketch(sets, total))
    one = near.candidates(sets, sketch, total)
    uncut = {tuple(r) for r in one.collect()}
    monkeypatch.setattr(near, "MOST_CLASSES", 8)
    monkeypatch.setattr(near, "POSTINGS", 200)
    assert near.cut_of(total)[0] == 8 and near.cut_of(total)[1] > 4
    assert {tuple(r) for r in near.candidates(sets, sketch, total).collect()} == uncut
    pdf = sets.toPandas()
    signed = pd.concat(list(near._signatures([pdf])))
    pairs = pd.DataFrame(sorted(uncut), columns=["a", "b"])
    for x in "ab":
        pairs = pairs.merge(signed.rename(columns={"article_id": x, **{c: f"{c}_{x}" for c in ("n", "p2", "p3")}}), on=x)
    kept = {(int(a), int(b)) for out in near._intersected([pairs]) for a, b in out.itertuples(index=False)}
    of = [set(np.frombuffer(g, np.uint32).tolist()) for g in pdf["grams"]]
    cases = {(a, b) for a, b in uncut if 2 * len(of[a] & of[b]) > len(of[a] | of[b])}
    assert cases <= kept and len(kept) < len(uncut)


def test_hot_group(spark, monkeypatch):
    """20,000 copies of a text, and 300 edited ones: a row each, with links between different texts only."""
    texts = random_copies(6, 300, most=0.1)
    sets = gram_sets(list(range(300)), texts)
    hot = pd.concat([sets, *[sets.iloc[[0]].assign(article_id=k) for k in range(1000, 21_000)]])
    monkeypatch.setattr(near, "_HELD", 20_000)
    df = spark.createDataFrame(hot, near._SETS)
    rows = {r.article_id: (r.class_id, r.copies, r.links) for r in near.classes_of_sets(df).collect()}
    of = {}
    for k, g in zip(sets["article_id"], sets["grams"]):
        of.setdefault(g, k)
    reps = {k: set(np.frombuffer(g, np.uint32).tolist()) for g, k in of.items()}
    want = {k: sum(2 * len(a & b) > len(a | b) for j, b in reps.items() if j != k) for k, a in reps.items()}
    assert len(rows) == 20_300 and rows[20_999] == rows[0] and rows[0][1] >= 20_001
    assert {k: rows[k][2] for k in reps} == want


def test_copies_cost_no_candidates(spark, monkeypatch):
    """However often rows are repeated, different texts alone are counted, cut into classes and posted, by whichever list of ids is short."""
    sets = gram_sets(list(range(40)), random_copies(9, 40, most=0.6))
    sets = sets[~sets["equal"].duplicated()]
    seen = []
    real = near.candidates
    monkeypatch.setattr(near, "candidates", lambda rows, sketch, total: seen.append((sorted(r.article_id for r in rows.collect()), bytes(sketch.value), total)) or real(rows, sketch, total))
    links = sorted(map(tuple, near.links_of_sets(spark.createDataFrame(sets, near._SETS))[1].collect()))
    repeated = spark.createDataFrame(pd.concat([sets.assign(article_id=sets["article_id"] + 1000 * k) for k in range(5)]), near._SETS)
    for sent in (near.SENT_IDS, 100, 0):
        monkeypatch.setattr(near, "SENT_IDS", sent)
        assert sorted(map(tuple, near.links_of_sets(repeated)[1].collect())) == links
    assert links and len(seen) == 4 and all(x == seen[0] for x in seen)


def test_near_copies_leave_furniture_out(spark):
    copy = pages(spark).where("article_id = 3").first()
    extra = [(60, "https://www.left-paper.org/60", copy.title, copy.content.replace("Our pages: all news, all day", "Weather | Traffic | Sports"), "Left Paper", None, "", 0)]
    got = {tuple(r) for r in near_copies(pages(spark, extra)).collect()}
    assert (3, 60) in got


def test_repeated_lines(spark):
    rows = [(i, "A", f"Share   {i}\n\nown {'x' * i}\nTWICE") for i in range(6)] + [(10 + i, "A", "twice\ntwice") for i in range(3)] + [(20 + i, "B", "few") for i in range(4)] + [(30, None, "few"), (31, "A", None), (32, "C", "")]
    df = spark.createDataFrame(rows, "article_id bigint, source string, content string").withColumns({"line_text": F.lit("clash"), "total": F.lit(1)})
    assert {tuple(r) for r in repeated_lines(df).collect()} == {("A", "share 0"), ("A", "twice")}
    out = {r.article_id: (r.content, r.n_removed) for r in without_repeated(df).collect()}
    assert out[1] == ("\nown x", 2) and out[10] == ("", 2) and out[30] == ("few", 0) and out[31] == (None, None) or out[31][0] is None
    many = spark.createDataFrame([(i, "S", "hot" if i < 100 else "l" * i) for i in range(1001)], "article_id bigint, source string, content string")
    assert repeated_lines(many).count() == 0
