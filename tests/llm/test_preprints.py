import pytest

from tessellar.llm import passages as P
from tessellar.llm import preprints as R


def text(said):
    return "<a><p>" + " ".join(said) + "</p></a>"


def sentences(word, n=12):
    return [f"This is sentence number {k} of the {word} on ação {k * 7}." for k in range(n)]


def table(spark, rows):
    return spark.createDataFrame([(k, t, *more) for k, t, *more in rows], "k string, xml string, doi string, title string, authors array<struct<name: string>>, version string, pub_date string, license string, subject_heading string, subject_europepmc_category string, article_type string, language string, keywords array<string>, xml_source_url string")


def row(k, said, doi="", title="A study of something long", who=("Ana Belmonte",), version="1"):
    return (k, text(said) if said is not None else None, doi, title, [(w,) for w in who], version, "2024-01-01", "", "", "", "", "pt", ["x"], "u")


SAID = sentences("study")


def test_records_of_one_preprint(spark, shared):
    df = table(spark, [
        row("P3", SAID, "10.1234/abc"), row("P1", [*SAID[:5], "A new sentence was written here.", *SAID[6:]], "https://doi/10.1234/ABC.v2"),
        row("P2", [s.encode().decode("cp1252") for s in SAID], "10.1234/y"), row("P4", sentences("sequel"), "10.1234/z", "Another long title of a sequel"),
        row("P5", None, "", "", ()), row("P6", [], "10.1234/prelo.0", "", ()), row("P7", sentences("third text"), "10.1234/prelo.0", "A third and different long title", ("Rui Costa",)),
    ])
    got = {tuple(r) for r in R.same_preprint(df, "k", "xml").collect()}
    assert got == {(k, "P1") for k in ("P1", "P2", "P3")}
    assert R.same_preprint(df.limit(0), "k", "xml").count() == 0


def test_hot_copies_are_one_class(spark, shared):
    df = table(spark, [row(f"P{n:03}", SAID) for n in range(200)] + [row("Q", sentences("other"), title="Something else entirely", who=("Rui Costa",))])
    got = R.same_preprint(df, "k", "xml").collect()
    assert len(got) == 200 and {r.group for r in got} == {"P000"}


def brute(docs, part=P.SHARED):
    marks = {}
    for k, said in docs.items():
        b = [0, *said] if len(said) < P.SHORT else said
        marks[k] = set(zip(b, b[1:]))
    keys = sorted(k for k in docs if marks[k])
    return {(a, b) for i, a in enumerate(keys) for b in keys[i + 1 :] if len(marks[a] & marks[b]) / min(len(marks[a]), len(marks[b])) >= part}


@pytest.mark.parametrize("common", [P.COMMON, 2])
def test_prefix_filter_is_exact(spark, shared, monkeypatch, common):
    import random

    monkeypatch.setattr(P, "COMMON", common)
    rng = random.Random(2)
    boiler = [900, 901, 902, 903]
    docs = {}
    for n in range(60):
        own = [n * 100 + i for i in range(rng.randrange(2, 12))]
        docs[f"d{n:02}"] = boiler[: rng.randrange(5)] + own + boiler[2:]
    for n in range(0, 30, 3):
        docs[f"e{n:02}"] = docs[f"d{n:02}"][: rng.randrange(3, 9)] + [50_000 + n, 50_001 + n, 50_002 + n]
    df = spark.createDataFrame([(k, said) for k, said in docs.items()], "k string, said array<bigint>")
    _, marks = P.classes(df)
    assert {tuple(r) for r in P.similar(marks).collect()} == brute(docs)


@pytest.mark.parametrize("shard", [P.SHARD, 3])
def test_automata_find_every_passage(spark, shared, shard):
    train = spark.createDataFrame([("t1", list(range(1, 20))), ("t2", [5, 6, 99, 7, 8]), ("t3", [])], "rep string, said array<bigint>")
    held = spark.createDataFrame([("e1", [100, *range(4, 16)]), ("e2", [6, 99]), ("e3", [1])], "rep string, said array<bigint>")
    from pyspark.sql import functions as F

    hashed = {r.h: (r.x, r.y) for r in spark.createDataFrame([(x, y) for x in [0, *range(1, 130)] for y in range(130)], "x bigint, y bigint").withColumn("h", F.xxhash64("x", "y")).collect()}
    got = {(r.rep, hashed[r.mark]) for r in P.matches(held, train, shard).collect()}
    want = {("t1", (n, n + 1)) for n in range(4, 15)} | {("t2", (5, 6)), ("t2", (7, 8)), ("t2", (6, 99))}
    assert got == want


def test_cross_split(spark, shared):
    df = table(spark, [row("P1", SAID), row("P2", SAID), row("P3", [*SAID[:8], "Something new is said here."]), row("P4", sentences("sequel")), row("P5", None)])
    splits = spark.createDataFrame([("P1", True), ("P2", False), ("P3", False), ("P4", True), ("P5", True)], "k string, train boolean")
    got = {tuple(r) for r in P.cross_split(df, "k", "xml", splits).collect()}
    assert {(i, t) for i, t, _ in got} == {("P1", True), ("P2", False), ("P3", False)} and len({g for *_, g in got}) == 1


def test_two_sided_quality():
    truth = R.two_sided([((True, True, True), 100), ((False, False, False), 300), ((True, False, True), 10), ((False, True, False), 40), ((True, None, True), 5)])
    assert truth[True, True, True] > 0.9 > 0.1 > truth[False, True, False] and truth[True, False, True] > 0.5 and truth[True, None, True] > 0.9
    assert R.two_sided([]) == {}


def test_survivor_keeps_what_is_surely_true(spark, shared):
    df = table(spark, [row("P1", SAID, "10.1234/abc", version="2"), row("P2", SAID, "doi:10.1234/ABC", title="A STUDY OF SOMETHING LONG", version="v2"), row("P3", SAID, "10.1239/other", title="A study of s�mething", who=("Ana Belmonte", "Rui Costa"), version="1")])
    groups = spark.createDataFrame([("P1", "P1"), ("P2", "P1"), ("P3", "P1")], "id string, group string")
    one = R.survivors(df, "k", groups).collect()
    assert len(one) == 1 and (one[0].doi, one[0].title, one[0].language) == ("10.1234/abc", "A study of something long", "pt")
    assert "Ana Belmonte" in one[0].author_names and one[0].license is None


def test_sentences_of_odd_paragraphs():
    one, two = "Primeira frase bem longa", "Segunda frase bem longa"
    want = P.sentence_hashes(f"<p>{one}</p><p>{two}</p>")
    assert len(set(want)) == 2
    for text in (f"<p>{one}. {two}.</p>", f"<p x='1'>{one}!\xa0{two}</p>", f"<p>{one}.  </p>\n<p>\n {two}</p>", f"<p>{one}&amp;</p><p>&#160;<i>{two}</i></p>", f"<pre>x</pre><p>{one}.\u2003..\u3000{two} ?</p><p>{one}"):
        assert P.sentence_hashes(text) == want
    assert P.sentence_hashes(f"<p>{one}<p>{two}</p>{one}</p>") == P.sentence_hashes(f"<p>{one} {two}</p>") and P.sentence_hashes(None) == P.sentence_hashes("<p") == []
