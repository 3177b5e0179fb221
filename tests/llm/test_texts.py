import random

import pytest

from tessellar.llm import language as L
from tessellar.llm import lookalike as K

SAID = {
    "pt": "A comissão organizadora revisou o plano sobre a saúde da população. Não houve diferença significativa entre os grupos. Os resultados indicam que a variação não depende apenas das condições locais.",
    "es": "La comisión organizadora revisó el plan sobre la salud de la población. No hubo diferencia significativa entre los grupos. Los resultados indican que la variación no depende solo de las condiciones locales.",
    "en": "The organising committee reviewed the plan on the health of the population. There was no significant difference between the groups. The results show that the variation does not depend on local conditions alone.",
}


def lines(lang, n, rng):
    cut = SAID[lang].split(". ")
    return [". ".join(rng.choices(cut, k=3)) + f" ({rng.randrange(999)})." for _ in range(n)]


def article(lang, paragraphs):
    return f'<article xml:lang="{lang}"><front><abstract><p>x</p></abstract></front><body>' + "".join(f"<p>{p}</p>" for p in paragraphs) + "</body></article>"


def test_languages_in_spite_of_wrong_labels(spark):
    rng = random.Random(3)
    rows = [(f"{lang}{n:03}", lang if n % 8 else {"pt": "es", "es": "en", "en": "pt"}[lang], article(lang, lines(lang, 6, rng))) for lang in SAID for n in range(40)]
    mixed = article("pt", [*lines("pt", 3, rng), *lines("en", 1, rng)])
    rows += [("mix", "pt", mixed), ("bad", "pt", "not xml"), ("null", "pt", None), ("none", "", "<article/>"), ("abstract", "xx", f"<article><front><abstract><p>{SAID['es']}</p></abstract></front></article>")]
    df = spark.createDataFrame(rows, "k string, language string, xml string")
    told = L.languages(df, "k", "xml", L.fitted(df, "k", "xml", "language"), "language")
    got = {(r.k, r.para_no): (r.lang, r.confidence) for r in told.collect()}
    assert all(got[k, n][0] == k[:2] for k, _, _ in rows[:120] for n in range(7))
    assert [got["mix", n][0] for n in range(5)] == ["pt", "pt", "pt", "pt", "en"] and got["abstract", 0][0] == "es" and got["none", 0][0] is None
    assert not {"bad", "null"} & {k for k, _ in got} and all(0 <= s <= 1 for _, s in got.values())
    wrong = {(r.k, r.para_no) for r in L.mislabelled(told).collect()}
    assert wrong == {(k, 0) for k, lang, _ in rows[:120] if lang != k[:2]} | {("mix", 4), ("abstract", 0)}


def test_segments_and_no_language(spark):
    rng = random.Random(4)
    c = L.trained({lang: lines(lang, 60, rng) for lang in SAID})
    assert c.language("") == c.language("12 %") == (None, 0.0) and L.Classifier({}).language("text") == (None, 0.0)
    df = spark.createDataFrame([(1, SAID["pt"] + " " + SAID["en"]), (2, None), (3, "")], "k int, t string")
    got = [(r.k, r.seg_no, r.lang) for r in L.segments(df, "k", "t", c).orderBy("k", "seg_no").collect()]
    assert got == [(1, 1, "pt"), (1, 2, "en")]


SAME = [("ação", "ação"), ("escola", "еѕсоlа"), ("word", "wo​rd"), ("A1 b", "Ａ１　ｂ"), ("find", "ﬁnd"), ("273 K", "273\xa0K"), ("ë", "ё"), ("naïve", "nаїve"), ("VIII", "Ⅷ"), ("co-op", "co‐op"), ("x", "x️")]
OTHER = [("são", "sao"), ("A", "a"), ("x, y", "x y"), ("β", "ß"), ("a-b", "a–b"), ("1", "l"), ("α", "a"), ("й", "и"), ("x²", "x2")]


def test_one_form(spark):
    texts = [t for pair in SAME + OTHER for t in pair]
    df = spark.createDataFrame([(n, t) for n, t in enumerate(texts)] + [(900, None), (901, ""), (902, "long text – " * 5000)], "k int, t string")
    form = {r.k: r.form for r in K.forms(df, "k", "t").collect()}
    assert 900 not in form and form[901] == "" and form[902] == "long text – " * 5000
    for n, (a, b) in enumerate(SAME + OTHER):
        assert (form[2 * n] == form[2 * n + 1]) == (n < len(SAME)), (a, b, form[2 * n], form[2 * n + 1])


def test_pairs(spark):
    df = spark.createDataFrame([(1, "one"), (2, "onе"), (3, "one"), (4, "two"), (5, None), (6, "two")], "id bigint, t string")
    assert {tuple(r) for r in K.lookalike_pairs(df, "id", "t").collect()} == {(1, 2), (2, 3)}
    assert K.lookalike_pairs(df.limit(0), "id", "t").count() == 0


@pytest.mark.parametrize("quote", ["it's", "don''t", "%s {x} \\d"])
def test_sql_signs_in_texts_are_text(spark, quote):
    df = spark.createDataFrame([(1, quote + "​"), (2, quote)], "id bigint, t string")
    assert {r.form for r in K.forms(df, "id", "t").collect()} == {quote}
