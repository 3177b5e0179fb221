import pytest

from pyspark.sql import functions as F
from tessellar.llm.mojibake import repair, suspect


def spoil(text, true, wrong):
    return text.encode(true).decode(wrong)


def test_prefilter_drops_only_what_repair_leaves(spark):
    texts = ["committee ÔÇô made up of", "it isnÔÇÖt", spoil("a β value of σ", "utf-8", "mac_roman"), "clean text", "educação – l’âge", "", "EDUCA??O"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    dropped = {r.t for r in df.where(~suspect(F.col("t"))).collect()}
    assert all(repair(t)[1] == "" for t in dropped)
    assert not dropped & set(texts[:3])
    assert repair(texts[0]) == ("committee – made up of", "span")


@pytest.mark.parametrize("text", ["95.5 ? 5.3 units", "of 24 ?C.", "nobody talks about?? in the area", "selon l?ƒge", "EDUCA??O", "S?O", "a ?rea urbana", "<given-names>Jos?</given-names>", "<given-names>Jos? Maria</given-names>"])
def test_question_marks_for_letters_are_found(text):
    assert "loss" in repair(text)[1]


@pytest.mark.parametrize("text", ["Why now? The", "à Pré-Cagui ? D’après", "villa danoéu? evidencias de", "Dogacoón?. ¿Por qué", "<p>Why?</p>", "Why? (α = 0,05)", "see https://a.example/b?c=d"])
def test_questions_are_clean(text):
    assert repair(text)[1] == ""


@pytest.mark.parametrize("text", ["a � b", "CO₂ rises", "from a → b", "x ∈ y", "5 m² and 10⁻³", "Привет", "Việt Nam", "Timișoara", "e\u0301", "é→ç", "数据", "a 😀 b"])
def test_every_decodable_character_of_a_span_is_decoded(text):
    assert repair(spoil(text, "utf-8", "mac_roman"))[0] == text
    assert "span" in repair(spoil(text, "utf-8", "mac_roman"))[1]


@pytest.mark.parametrize("text", ["groß“ und", "la santé\xa0» est", "der Spaß“.", "tamanho é grande", "«ação»"])
def test_clean_neighbours_are_no_span(text):
    assert repair(text) == (text, "")


@pytest.mark.parametrize("text, true, wrong", [("la cicatrización de", "mac_roman", "cp1252"), ("una clínica de", "mac_roman", "cp1252"), ("el período de", "mac_roman", "cp1252"), ("del año 1996", "mac_roman", "cp1252"), ("González", "cp1252", "mac_roman"), ("González", "cp1252", "cp437"), ("González", "cp1252", "cp850")])
def test_swaps_that_show_as_clean_signs_are_found_and_read(text, true, wrong):
    assert repair(spoil(text, true, wrong)) == (text, "swap")


@pytest.mark.parametrize("text", ["Jusqu’alors l’âge", "it isn’t the teachers’ plan", "organizador —formado por 18 docentes— revisó", "pages 3–9", "col·legi", "Maßnahme groß", "Qur’an"])
def test_clean_signs_between_letters_stay(text):
    assert repair(text) == (text, "")


def test_layers_of_several_places_are_all_undone():
    title, body, back = "educação", "Привет мир", "coração é só"
    spoilt = title
    for _ in range(5):
        spoilt = spoil(spoilt, "utf-8", "mac_roman")
    spoilt = f"<a>{spoilt}</a><b>{spoil(body, 'utf-8', 'cp866')}</b><c>{spoil(back, 'utf-8', 'cp437')}</c>"
    assert repair(spoilt) == (f"<a>{title}</a><b>{body}</b><c>{back}</c>", "span")


@pytest.mark.parametrize("text", ["O AVÓ E", "DO PÔ", "<p>„X“ AVÓ</p>"])
def test_capital_words_ending_in_an_accented_o_are_restored(text):
    assert repair(text.replace("Ó", "Ã“").replace("Ô", "Ã”")) == (text, "span")


@pytest.mark.parametrize("text", ["“TERÃ”", "AMANHÃ” disse", "„TERÃ“", "“CAFÉ”"])
def test_capital_and_closing_mark_stay(text):
    assert repair(text) == (text, "")
