import itertools

import pytest

from tessellar.llm import names as N


@pytest.mark.parametrize(
    ("a", "b", "level"),
    [
        ("José da Silva", "Jose SILVA", 2), ("Silva, José", "José Silva", 2), ("J. Silva", "José Silva", 1), ("JM Silva", "José Maria Silva", 1), ("José Sliva", "José Silva", 2),
        ("José Silva", "José Silva Pereira", 1), ("Luís Silva", "Luisa Costa", 0), ("Ana Silva", "Rui Silva", 0), ("JosÃ© Silva", "José Silva", 2), ("Jos� Silvano", "José Silvano", 2), ("Silva", "José Silva", 0),
    ],
)
def test_person_levels(a, b, level):
    assert N.person_level(tuple(sorted(N.tokens(a))), tuple(sorted(N.tokens(b)))) == level


def test_common_given_names_do_not_tell():
    cut = lambda s: tuple(sorted(N.tokens(s)))
    given = frozenset({"maria", "clara", "marina"})
    assert N.person_level(cut("Maria Clara"), cut("Maria Clara Souza"), given=given) == 0
    assert N.person_level(cut("Maria Souza"), cut("Marina Souza"), given=given) == 0
    assert N.person_level(cut("Zeca Souza"), cut("Jose Souza"), frozenset({("zeca", "jose"), ("jose", "zeca")})) == 1


def test_left_out_parts():
    level = lambda a, b: N.person_level(*(tuple(sorted(N.tokens(x))) for x in (a, b)), given=frozenset({"maria", "clara"}))
    assert level("Clara Souza", "Clara Maria Souza Galutadao") == 0 and level("C. Souza", "C. M. Souza Galutadao") == 0
    assert level("G. Souza", "Maria Souza Galutadao") == 0 and level("M. Souza", "Maria Souza Galutadao") == 1
    assert level("Maria Souza", "Maria Clara Souza") == 1 and level("Maria Souza", "Maria Souza Galutadao") == 1


def cut(s):
    return tuple(x for n, part in enumerate(s.split(",", 1)) for x in ((",",) * n + N.tokens(part, False)))


@pytest.mark.parametrize(
    ("a", "b", "level"),
    [
        ("Universidade Federal de Nogoonte", "UNIVERSIDADE FEDERAL DE NOGOONTE", 2), ("Nogoonte, Universidade Federal", "Universidade Federal de Nogoonte", 2), ("Univ. Fed. Nogoonte", "Universidade Federal de Nogoonte", 2),
        ("UF – Universidade Federal de Nogoonte", "Universidade Federal de Nogoonte", 2), ("Universidade Federal de Nogoonte, Vila Rica", "Universidade Federal de Nogoonte", 2), ("Universidade Fedreal de Nogoonte", "Universidade Federal de Nogoonte", 2),
        ("TH Loboui", "Technische Hochschule Loboui", 2), ("Universidade Estadual de Nogoonte", "Universidade Federal de Nogoonte", 1), ("UFAGUA", "UEAGUA", 0), ("Technische Hochschule Loboui", "Loboui University of Applied Sciences", 1),
    ],
)
def test_organisation_levels(a, b, level):
    assert N.organisation_level(cut(a), cut(b)) == level


def test_acronyms():
    words = ("universidade", "federal", "serra", "cureuba")
    assert N.acronym("ufserr", words) and not N.acronym("ueserr", words) and not N.acronym("u", words)


def test_subsequence_and_alike():
    assert N.subsequence("abcbdab", "bdcaba") == 4 and N.subsequence("", "x") == 0
    assert N.alike("bomicanha", "bomiacnha") and N.alike("l*via", "livia") and not N.alike("donodoreto", "najodoreto") and not N.alike("ana", "eva")


@pytest.mark.parametrize(("common", "block"), [(50, 200), (2, 3)])
def test_blocks_lose_no_pair(spark, shared, common, block):
    people = ["Ana Paula Silva", "Ana Silva", "A. Silva", "Ana Siilva", "Rui Costa", "Rui M. Costa", "R Costa", "Rita Costa", "Ana Costa", "Bia Souza Lima", "Bia Souza-Lima", "Beatriz Sousa Lima"] + [f"Ana Nome{x}anez" for x in "abcdefgh"]
    units = {" ".join(sorted(N.tokens(p))) for p in people}
    want = {(a, b, lv) for a, b in itertools.combinations(sorted(units), 2) if (lv := N.person_level(tuple(a.split()), tuple(b.split())))}
    df = spark.createDataFrame([(u,) for u in units] + [(next(iter(units)),)], "unit string")
    got = {tuple(r) for r in N.suffix_pairs(df, N.person_level, common=common, block=block).collect()}
    assert got <= want and {w for w in want if w[2] == 2} <= got and len(want - got) <= 1


@pytest.mark.parametrize("common", [2, 20])
def test_mistakes_anywhere_meet_under_common_keys(spark, shared, common):
    # mistakes in the first and in the last letters, beside an initial or a nickname, among many bearers of one surname
    people = ["Joana Galutadao", "Jaona Galutadao", "Ojana Galutadao", "J. Galutadoa", "Paty Galutadao", "Patricia Galutadao", "Ze Galutadao", "Jose Galutadao", "Jo*na Galutadao", "J*ana Galut*dao", "Joana Gal*t*dao"]
    people += [f"{x}{y}nisio Galutadao" for x in "BDFGKLMN" for y in "aeiou"] + ["Sem Parente"]
    nicks = frozenset(p for a, b in [("paty", "patricia"), ("jose", "ze")] for p in [(a, b), (b, a)])
    level = lambda a, b: N.person_level(a, b, nicks)
    units = sorted({" ".join(sorted(N.tokens(p))) for p in people})
    want = {(a, b, lv) for a, b in itertools.combinations(units, 2) if (lv := level(tuple(a.split()), tuple(b.split())))}
    assert {("galutadao joana", "galutadao ojana", 2), ("galutadao joana", "galutadoa j", 1), ("galutadao patricia", "galutadao paty", 1), ("galutadao jose", "galutadao ze", 1)} <= want
    df = spark.createDataFrame([(u,) for u in units], "unit string")
    assert {tuple(r) for r in N.suffix_pairs(df, level, common=common, block=7, nicks=nicks).collect()} == want


@pytest.mark.parametrize("block", [2, 200])
def test_only_groups_with_an_initial_are_held(spark, shared, block):
    # under one surname: no given name of N or T is abbreviated, so these do not meet by their first letters
    given = ["m", "maria", "marta", "mona", "mirta", "mo", "nadia", "nora", "nilza", "tania", "tilda"]
    rest = spark.createDataFrame([("galutadao", f"{g} galutadao", g) for g in given], "key string, unit string, token string")
    names = spark.createDataFrame([(g, g) for g in given], "token string, key string")
    refined = N.refinement(rest, names)
    cells = {}
    for r in N.held_groups(refined, block).where("brief").collect():
        cells.setdefault((r.key, r.cell), set()).add(r.unit.split()[0])
    assert {g for m in cells.values() for g in m} == {g for g in given if g[0] == "m"}
    together = {p for m in cells.values() for p in itertools.combinations(sorted(m), 2)}
    assert {tuple(sorted((x, g))) for x in ("m", "mo") for g in given if g[0] == "m" and g != x} <= together
    assert not N.held_groups(refined, block).where("NOT brief").count()


def test_kin_share_a_key(spark, shared):
    tokens = ["joana", "jaona", "ojana", "joaan", "jona", "jooana", "jo*na", "j**na", "joan*", "marina", "mariana", "ma*ia", "maria", "ana", "*na", "xyz"]
    got = {}
    for r in N.kin(spark.createDataFrame([(t, 1 + len(t) % 3) for t in tokens], "token string, n int")).collect():
        got.setdefault(r.token, set()).add(r.key)
    assert all(got[a] & got[b] for a, b in itertools.combinations(tokens, 2) if N.near(a, b)) and got["xyz"] == {"xyz"}


def test_common_endings_are_no_common_keys(spark, shared):
    tokens = [f"{x}{y}rabatel" for x, y in itertools.product(["ba", "ce", "di", "fo", "gu"], repeat=2)]
    got = [tuple(r) for r in N.kin(spark.createDataFrame([(t, 1) for t in tokens], "token string, n int")).collect()]
    assert sorted(got) == sorted((t, t) for t in tokens)


@pytest.mark.parametrize("brief", [False, True])
def test_names_of_a_group_meet_by_every_token(brief):
    # many bearers of one name beside another, of which few can be one person: only these are compared, and all of them
    endings = itertools.product("bcdfglmn", "aeiou", ["rabatel", "lojavico", "motandes", "dilindra", "pegateira", "fusobuck"])
    people = [f"Ulrike Marga {a}{b}{c}" for a, b, c in endings]
    people += ["Ulrike Marga", "Marga Ulrike Barabatle", "U. M. Barabatel", "Ulrike M. Barabatel", "Ulrike Barabatel", "Uli Marga Barabatel", "Ulr*ke M*rga B*rabatel", "Ulrike Marga B*r*batel", "UM Barabatel", "Ulrike Marga Ana Barabatel", "Ulrike Marga Ana Eva Barabatel"]
    nicks = frozenset([("uli", "ulrike"), ("ulrike", "uli")])
    names = sorted(tuple(sorted(N.tokens(p))) for p in people)
    told = lambda n, m: (not brief or any(len(t) <= 2 for t in names[n] + names[m])) and N.person_level(names[n], names[m], nicks)
    want = {x for x in itertools.combinations(range(len(names)), 2) if told(*x)}
    got = list(N.meetings(names, brief, {"uli": ["ulrike"], "ulrike": ["uli"]}))
    assert want and want <= set(got) and len(got) == len(set(got)) < 0.35 * len(names) * (len(names) - 1) / 2


def rows(*people):
    return [(k, [(n, o, a) for n, o, a in authors]) for k, authors in people]


def test_pairs_of_people_and_organisations(spark, shared):
    uni = "Universidade Federal de Nogoonte"
    data = rows(
        ("1", [("José Alencastro", "0000-0700-0000-0001", [uni]), ("Ana Belmonte", "", [uni])]),
        ("2", [("Alencastro, José", "0000070000000001", [uni.upper()]), ("A. Belmonte", "", [uni])]),
        ("3", [("J. Alencastro", "", [uni]), ("", "", None), (None, None, None)]),
        ("4", [("José Alencastro", "0000-0700-0000-0002", ["Outra Escola"])]),
        ("5", []),
    )
    df = spark.createDataFrame([*data, data[0], ("6", None)], "k string, authors array<struct<name: string, orcid: string, affiliations: array<string>>>")
    got = {tuple(r) for r in N.name_pairs(df, "k", "authors").collect()}
    assert got == {
        ("person", "Alencastro, José", "José Alencastro"), ("person", "Alencastro, José", "J. Alencastro"), ("person", "J. Alencastro", "José Alencastro"), ("person", "A. Belmonte", "Ana Belmonte"),
        ("organisation", uni.upper(), uni),
    }
    assert N.name_pairs(df.limit(0), "k", "authors").count() == 0
    people = {(r.k, r.person) for r in N.author_persons(df, "k", "authors").collect()}
    assert ("1", "0000070000000001") in people and ("3", "0000070000000001") in people and ("4", "0000070000000002") in people


def test_abbreviated_names_stay_in_their_organisation(spark, shared):
    uni, school = "Universidade Federal de Nogoonte", "Escola Superior Vila Rica"
    data = rows(
        ("1", [("Joana Alencastro Belmonte", "0000-0700-0000-0001", [uni])]),
        ("2", [("Joana Alencastro", "", [school])]),
        ("3", [("Alencastro Belmonte, J.", "", [school])]),
        ("4", [("Joana Galutadao Belmonte", "0000-0700-0000-0002", [uni])]),
        ("5", [("Joana Galutadao", "", [uni])]),
        ("6", [("J. Galutadao", "", [])]),
    )
    df = spark.createDataFrame(data, "k string, authors array<struct<name: string, orcid: string, affiliations: array<string>>>")
    who = {r.k: r.person for r in N.author_persons(df, "k", "authors").collect()}
    assert who["2"] != who["1"] == who["3"] and who["4"] == who["5"] == who["6"]


def test_chance_nicknames_are_not_learnt(spark, shared):
    uni = ["Universidade Federal de Nogoonte"]
    data = []
    for n, surname in enumerate("galutadao belmonte alencastro visalubim nolacudez lobajabal memajarner gabomoras dopevindra nasavedez cofimirin redibonha".split()):
        name = ("Robert Esther " if n < 2 else "Robert ") + surname.title()
        data += [(f"{n}{m}", [(x, f"0000-0700-0000-00{n:02}", uni)]) for m, x in enumerate((name, name, "Bob " + surname.title()))]
    data += [("x", [(f"Esther {x}{y}taconha", "", uni) for x in "BDFG" for y in "aeiou"])]
    people = N.mentions(spark.createDataFrame(data, "k string, authors array<struct<name: string, orcid: string, affiliations: array<string>>>"), "k", "authors")
    assert N.learnt_nicknames(people, N._tokenised(people, commas=False)) == {("bob", "robert"), ("robert", "bob")}
