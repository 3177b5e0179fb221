"""Variant spellings of names: which strings mean the same person or the same organisation.

Blocking by tokens.  Every name is mended, folded and cut into tokens.  A token's index keys are itself and each
more frequent token that is one letter apart (``kin``: found by what is left of both without a letter), so two
spellings of a token share a key wherever the mistake is.  Keys borne by more than ``COMMON`` names are refined by
the keys of another token, and by its first letter where one name has an initial only.
Groups of the refinement are held in blocks, however large they are; none is left out.  In a block names meet by
sets of bits: only those that may have a partner for every token of the shorter name (``meetings``) are compared,
token by token, by the ratio of their longest common subsequence.

Strings alone do not tell which of several possible bearers an abbreviated name means, so persons are
resolved as bearers (name, ORCID, organisation): equal ORCIDs are one person, bearers without one join
the best fitting person that has one, and the rest are joined among themselves.  Organisations are
joined by spelling, and by people who bear both spellings where words were translated or abbreviated.

Null and blank names take part in nothing.  Repeated mentions count once.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import combinations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessellar.llm.forest import components, cut, sent
from tessellar.llm.mojibake import repair

#: Shortest token indexed, names a key may have before it is refined by a second token, and names compared in one block.
WORD, COMMON, BLOCK = 3, 20, 200
#: Ratio of the longest common subsequence from which two tokens are spellings of one.
ALIKE = 0.75
#: Share of all names from which a word is a common given name.
GIVEN = 0.0025
#: Share of all spellings of organisations up to which a word is a rare one.
RARE = 0.04
#: Nicknames are learnt: two given names borne under one ORCID beside the same surname, by so many people, and by
#: this share of those by whom the rarer of both stands for its usual one; names of many people are confused by chance.
NICK_SUPPORT, NICK_SHARE, MOST_NICKS = 2, 0.2, 200_000

#: Words that link parts of names.
PARTICLES = frozenset("a da das de del della der di do dos du e el et la le les of the und van von y".split())

_WORD = re.compile(r"[^\W_*]+(?:\*+[^\W_]+)*\*?|\*+[^\W_]+")
_LOST = re.compile(r"(?<=\w)[?�]+|[?�]+(?=\w)")


@lru_cache(1 << 16)
def tokens(name: str | None, initials: bool = True) -> tuple[str, ...]:
    """Folded tokens of a name in order: mended, without accents, case and particles; lost characters are '*'.

    With ``initials`` a word of two capitals counts as two initials.
    """
    if not name:
        return ()
    text = name if name.isascii() else repair(name)[0]
    text = _LOST.sub("*", text)
    plain = text if text.isascii() else "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))
    out = []
    for word in _WORD.findall(plain):
        low = word.casefold()
        if low in PARTICLES and not (len(word) == 1 and word.isupper()):
            continue
        out.extend(low if initials and len(word) == 2 and word.isupper() and word.isascii() else [low])
    return tuple(out)


@lru_cache(1 << 18)
def subsequence(a: str, b: str) -> int:
    """Length of the longest common subsequence, by bit-parallel rows."""
    places: dict[str, int] = {}
    for n, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << n
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        hit = row & places.get(c, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


@lru_cache(1 << 18)
def alike(a: str, b: str) -> bool:
    """Two tokens that are spellings of one: equal, or one letter apart and of a high enough ratio; '*' stands for a lost letter."""
    if a == b:
        return True
    n, m = len(a), len(b)
    if min(n, m) < 3 or max(n, m) < 4 or abs(n - m) > 2:
        return False
    # where both have lost letters, these may be the same ones
    lost = max(a.count("*"), b.count("*"))
    shared = (subsequence(a.replace("*", ""), b.replace("*", "")) if lost else subsequence(a, b)) + lost
    return max(n, m) - shared <= 1 and 2 * shared >= ALIKE * (n + m) and shared - lost >= 2


def near(t: str, x: str) -> bool:
    """``alike``, tried only where nearly a half of both is equal, at the beginning or at the end, as one letter apart leaves it."""
    n, m = len(t), len(x)
    if -2 < n - m < 2:
        k = (min(n, m) - 2) // 2 or 1
        return (t[:k] == x[:k] or t[-k:] == x[-k:] or "*" in t or "*" in x) and alike(t, x)
    return -3 < n - m < 3 and ("*" in t or "*" in x) and alike(t, x)


def person_level(a: tuple[str, ...], b: tuple[str, ...], nicks: frozenset[tuple[str, str]] = frozenset(), given: frozenset[str] = frozenset()) -> int:
    """2: one name in two spellings; 1: possibly, parts are abbreviated, left out or nicknames; 0: no.

    Every token of the shorter name must have a partner in the longer one, and one of them must not be a
    common given name (``given``); two different common given names are never spellings of one.  What is left out
    is given names or other names, not both, and an initial is one of a given name if a given name is left over.
    """
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 2:
        return 0
    free, whole, telling, first, odd = list(b), 0, False, False, []
    for t in a:
        if t in free and len(t) > 1:
            free.remove(t)
            whole += len(t) > 2
            first = first or t in given
            telling = telling or (len(t) > 3 and t not in given)
        else:
            odd.append(t)
    later = []
    for t in odd:
        hit = next((x for x in free if len(x) > 2 and near(t, x) and not (t in given and x in given)), None) if len(t) > 2 else None
        if hit is None:
            later.append(t)
        else:
            free.remove(hit)
            whole += 1
            first = first or t in given or hit in given
            telling = telling or (len(t) > 3 and t not in given and hit not in given)
    if not telling:
        return 0
    surname = False
    for t in later:
        hit = next((x for x in free if (len(t) <= 2 and x.startswith(t)) or (len(x) <= 2 and t.startswith(x)) or (t, x) in nicks), None)
        if hit is None:
            return 0
        free.remove(hit)
        short, long = sorted((t, hit), key=len)
        surname = surname or (len(short) <= 2 < len(long) and long not in given)
    dropped = any(x in given for x in free)
    if (surname and dropped) or ((dropped or any(len(x) <= 2 for x in free)) and any(len(x) > 2 and x not in given for x in free)):
        return 0
    if whole >= 2:
        return 1 if any(len(x) > 3 and x not in given for x in free) or (dropped and first and whole == 2 and not later) else 2
    return 1 if whole and later else 0


def _abbreviates(short: str, long: str) -> bool:
    """'univ' for 'universidade', 'ctro' for 'centro'."""
    return len(short) < len(long) and 3 <= len(short) <= 7 and short[0] == long[0] and (long.startswith(short) or (len(short) == 4 and subsequence(short, long) == len(short)))


def organisation_level(a: tuple[str, ...], b: tuple[str, ...]) -> int:
    """2: one name in two spellings; 1: a long token is common, so people may decide; 0: no.

    Extra words of the longer name must be a code of up to four letters or what follows its comma
    (token lists carry the words after the comma after the mark ',').
    """
    left, right = ([t for t in x if t != ","] for x in (a, b))
    if len(left) > len(right):
        a, b, left, right = b, a, right, left
    if len(left) == 1 or len(right) == 1:
        return 2 if left == right else 0  # codes must be equal
    free, shared, lost = list(right), False, False
    for t in sorted(left, key=len, reverse=True):
        hit = t if t in free else next((x for x in free if alike(t, x) or _abbreviates(t, x) or _abbreviates(x, t)), None)
        if hit is not None:
            free.remove(hit)
            shared = shared or (len(t) >= 5 and alike(t, hit))
        elif 2 <= len(t) <= 4 and (said := next((free[n : n + len(t)] for n in range(len(free) - len(t) + 1) if "".join(x[0] for x in free[n : n + len(t)]) == t), None)):
            free = [x for x in free if x not in said]
        elif len(t) > 3:
            lost = True
            break
    if shared and not lost:
        cut = b.index(",") if "," in b else len(b)
        before, after = set(b[:cut]), set(b[cut + 1 :])
        extra = [x for x in free if len(x) > 3 or x == b[0]]
        if all(x in after or (len(x) <= 4 and x == b[0]) for x in extra) or (after and all(x in before for x in extra) and len(after) > 2):
            return 2
    return 1 if any(len(t) >= 5 and any(alike(t, x) for x in b if len(x) >= 5) for t in a) else 0


def acronym(code: str, words: tuple[str, ...]) -> bool:
    """Whether a code is made of beginnings of a name's words, in order, each giving at least a letter until it is used up."""
    words = tuple(w for w in words if w != ",")

    @lru_cache(None)
    def fits(at: int, word: int) -> bool:
        if at == len(code):
            return word >= 2
        if word == len(words):
            return False
        return any(code[at : at + n] == words[word][:n] and fits(at + n, word + 1) for n in range(1, min(len(words[word]), len(code) - at) + 1)) or (word > 0 and fits(at, word + 1))

    return len(code) >= 4 and fits(0, 0)


def _tokenised(strings: DataFrame, commas: bool) -> DataFrame:
    """``name``, ``unit`` (its tokens joined) of every distinct name; persons' tokens are sorted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(0).to_pylist()
            if commas:
                found = [tuple(x for n, part in enumerate(s.split(",", 1)) for x in ((",",) * n + tokens(part, False))) for s in names]
            else:
                found = [tuple(sorted(tokens(s))) for s in names]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([" ".join(c) for c in found], pa.string())], ["name", "unit"])

    return cut(strings.select("name").distinct().mapInArrow(run, "name string, unit string").where("unit <> ''"))


def _variants(tokens: DataFrame, extra: int) -> DataFrame:
    """``token``, ``variant``: hashes of a token without its lost letters and without up to 1 + ``extra`` other letters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole, short = [], []
            for token in batch.column(0).to_pylist():
                found = {token.replace("*", "")}
                for _ in range(1 + extra):
                    found |= {v[:n] + v[n + 1 :] for v in found for n in range(len(v))}
                whole.extend([token] * len(found))
                short.extend(found)
            for at in range(0, len(whole), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(whole[at : at + 100_000], pa.string()), pa.array(short[at : at + 100_000], pa.string())], ["token", "variant"])

    return tokens.select("token").mapInArrow(run, "token string, variant string").select("token", F.xxhash64("variant").alias("variant"))


def kin(words: DataFrame) -> DataFrame:
    """``token``, ``key``: every token itself, and the more frequent one of every two tokens that are ``near``.

    So any two tokens that are spellings of one share a key.  Two such tokens become equal if one letter at most is
    left out of each, besides lost ones; a token meets one with more lost letters if as many more are left out.
    """
    words = words.where("length(token) >= 3").select("token", "n", (F.length("token") - F.length(F.regexp_replace("token", "[*]", ""))).alias("lost"))
    words = cut(words)
    one = cut(_variants(words, 0))
    x, y = one.withColumnRenamed("token", "a"), one.withColumnRenamed("token", "b")
    met = x.join(y, "variant").where("a < b").select("a", "b")
    spoilt = words.where("lost = 1")
    wide = _variants(words.where("lost = 0"), 1).select(F.col("token").alias("b"), "variant")
    met = met.union(wide.join(sent(_variants(spoilt, 0)), "variant").select(F.col("token").alias("a"), "b"))
    many = sent(words.where("lost > 1").select(F.col("token").alias("a"), F.col("lost").alias("more")))
    # one known letter of the token with more lost ones may be missing in the other
    known = "length(translate(replace(a, '*', ''), b, '')) <= 1"
    met = met.union(many.crossJoin(words.withColumnRenamed("token", "b")).where("lost < more AND abs(length(a) - length(b)) <= 2").where(known).select("a", "b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column(0), batch.column(1)
            keep = pa.array([near(s, t) for s, t in zip(a.to_pylist(), b.to_pylist(), strict=True)], pa.bool_())
            yield batch.filter(keep)

    close = met.distinct().mapInArrow(run, "a string, b string")
    left, right = words.select(F.col("token").alias("a"), F.col("n").alias("na")), words.select(F.col("token").alias("b"), F.col("n").alias("nb"))
    ranked = close.join(left, "a").join(right, "b").select(F.array_sort(F.array(F.struct("na", "a"), F.struct(F.col("nb").alias("na"), F.col("b").alias("a")))).alias("two"))
    return cut(ranked.select(F.col("two")[0]["a"].alias("token"), F.col("two")[1]["a"].alias("key")).union(words.select("token", F.col("token").alias("key"))))


@lru_cache(1 << 18)
def _marks(token: str) -> tuple[str, ...]:
    """Beginnings and endings by which a token meets all that are ``near``, as long as these have no lost letters."""
    sizes = {(len(token) - 2) // 2 or 1, (len(token) - 3) // 2 or 1}
    return tuple(m for k in sizes for m in (token[:k] + "-", "-" + token[-k:]))


def meetings(names: list[tuple[str, ...]], brief: bool, partners: dict[str, list[str]]) -> Iterator[tuple[int, int]]:
    """Numbers ``n`` < ``m`` of all names of which ``person_level`` may be above 0; ``partners`` of each token are its nicknames.

    Every token of the shorter name has a partner: one with a mark of its own, with lost letters, a nickname, or one
    of two that begin alike and of which one is an initial.  With ``brief`` one of both names has an initial.
    """
    if len(names) <= 3:  # compared sooner than met
        yield from ((n, m) for n, m in combinations(range(len(names)), 2) if not brief or any(len(t) <= 2 for t in names[n] + names[m]))
        return
    marked: dict[str, int] = {}
    begun: dict[str, int] = {}
    short: dict[str, int] = {}
    exact: dict[str, int] = {}
    sized: dict[int, int] = {}
    lost = initial = 0
    for n, words in enumerate(names):
        bit = 1 << n
        sized[len(words)] = sized.get(len(words), 0) | bit
        for t in words:
            begun[t[:1]] = begun.get(t[:1], 0) | bit
            if len(t) <= 2:
                initial |= bit
                short[t[:1]] = short.get(t[:1], 0) | bit
            elif "*" in t:
                lost |= bit
            else:
                for m in _marks(t):
                    marked[m] = marked.get(m, 0) | bit
            if t in partners:
                exact[t] = exact.get(t, 0) | bit
    for n, words in enumerate(names):
        found = sized[len(words)] >> n + 1 << n + 1 | sized.get(len(words) + 1, 0) | sized.get(len(words) + 2, 0)
        if brief and not initial >> n & 1:
            found &= initial
        for t in words:
            if not found:
                break
            if "*" in t and len(t) > 2:
                continue
            some = lost | short.get(t[:1], 0)
            if len(t) <= 2:
                some |= begun[t[:1]]
            else:
                for m in _marks(t):
                    some |= marked[m]
            for x in partners.get(t, ()):
                some |= exact.get(x, 0)
            found &= some
        while found:
            m = (found & -found).bit_length() - 1
            found &= found - 1
            yield min(n, m), max(n, m)


def refinement(rest: DataFrame, names: DataFrame) -> DataFrame:
    """``key``, ``unit``, ``brief``, ``bears`` of names (``key``, ``unit``, ``token``: one other token) under common keys.

    Names meet by the keys of another token (``names``), or by its first letter (``brief``), where one of them ``bears`` it
    as an initial.
    """
    whole = rest.join(names.withColumnRenamed("key", "y"), "token").select(F.xxhash64("key", "y").alias("key"), "unit", F.lit(False).alias("brief"), F.lit(False).alias("bears"))
    initial = rest.select(F.xxhash64("key", F.substring("token", 1, 1), F.lit("")).alias("key"), "unit", F.lit(True).alias("brief"), (F.length("token") <= 2).alias("bears"))
    return cut(whole.union(initial).groupBy("key", "unit", "brief").agg(F.max("bears").alias("bears")))


def held_groups(refined: DataFrame, block: int) -> DataFrame:
    """``key``, ``unit``, ``cell``, ``brief``: groups of several names in pairs of blocks.

    A ``brief`` group is held if a name bears its initial; those that bear it meet all, the others only these.
    """
    sizes = refined.groupBy("key", "brief").agg(F.count(F.lit(1)).alias("m"), F.count_if("bears").alias("bearing")).where("m > 1 AND (bearing > 0 OR NOT brief)")
    # a large group is cut into blocks; a pair of blocks is one row, so no group is held whole
    ranges = [F.ceil(F.col(n) / block).cast("int") for n in ("m", "bearing")]
    own = [F.pmod(F.xxhash64("unit"), F.greatest(F.lit(1), n)).cast("int") for n in ranges]
    spread = refined.join(sizes, ["key", "brief"]).select("key", "unit", "brief", "bears", own[0].alias("own"), ranges[0].alias("blocks"), own[1].alias("first"), ranges[1].alias("firsts"))
    alike_cells = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.least(o, F.col("own")) * F.col("blocks") + F.greatest(o, F.col("own")))
    theirs = F.transform(F.sequence(F.lit(0), F.col("firsts") - 1), lambda o: o * F.col("blocks") + F.col("own"))
    bearers = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.col("first") * F.col("blocks") + o)
    cells = F.when(~F.col("brief"), alike_cells).when(F.col("bears"), F.array_union(theirs, bearers)).otherwise(theirs)
    return spread.select("key", "unit", F.explode(cells).alias("cell"), "brief")


def suffix_pairs(
    units: DataFrame,
    level: Callable[[tuple[str, ...], tuple[str, ...]], int],
    least: int = WORD,
    common: int = COMMON,
    block: int = BLOCK,
    given: frozenset[str] = frozenset(),
    nicks: frozenset[tuple[str, str]] = frozenset(),
    second: bool = True,
) -> DataFrame:
    """``a`` < ``b``, ``level`` > 0 of all pairs of ``unit``; none is missed if ``level`` keeps to what follows.

    Two names that are alike must have two tokens that are ``near``, of ``least`` letters and not ``given``.  With
    ``second`` two others must be near or ``nicks`` too, or one of them an initial of the other, as must every token of
    the shorter name and one of the longer, which has two more at most.
    """
    partners: dict[str, list[str]] = {}
    for p in nicks:
        for t, x in (p, p[::-1]):
            partners.setdefault(t, []).append(x)
    one = cut(units.select("unit").distinct())
    long = cut(one.select("unit", F.posexplode(F.split("unit", " ")).alias("place", "token")).where("token <> ','"))
    known = kin(long.groupBy("token").agg(F.count(F.lit(1)).alias("n")))
    tells = (lambda c: ~F.col(c).isin(*sorted(given))) if given else lambda c: F.lit(True)
    told = known.where(F.length("token") >= least).where(tells("token")).where(tells("key"))
    index = long.join(told, "token").select("unit", "place", "key")
    if not second:  # codes are equal or not
        index = index.union(one.select("unit", F.lit(0).alias("place"), F.regexp_replace("unit", " ?, ?", "").alias("key")).where("NOT contains(key, ' ')"))
    index = index.groupBy("key", "unit").agg(F.min("place").alias("place"), F.max("place").alias("other")) if second else index.select("key", "unit").distinct()
    index = cut(index)
    counted = index.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    held = index.join(counted, "key")
    small = held.where(F.col("n") <= common) if second else held.limit(0)
    if second:
        # a common key is refined by a second token, which may be left out where a name has an initial
        hot = held.where(F.col("n") > common).withColumn("first", F.when(F.col("place") == F.col("other"), F.col("place"))).select("key", "unit", "first")
        also = known.sparkSession.createDataFrame([(t, max(p)) for p in nicks for t in p], "token string, key string")
        names = known.union(also).distinct()
        rest = hot.join(long, "unit").where("first IS NULL OR place <> first")
        refined = refinement(rest, names)
    else:
        refined = held.select(F.xxhash64("key").alias("key"), "unit", F.lit(False).alias("brief"), F.lit(False).alias("bears"))
    last = held_groups(refined, block)
    groups = small.select(F.xxhash64("key").alias("key"), "unit", F.lit(0).alias("cell"), F.lit(False).alias("brief")).unionByName(last)
    # at most 2 x BLOCK names, by the bounds above (hashing may exceed it a little)
    lists = groups.groupBy("key", "cell", "brief").agg(F.collect_set("unit").alias("units")).where("size(units) > 1").select("units", "brief")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[tuple[str, str], int] = {}
            for members, brief in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                parts = [(u, tuple(u.split(" "))) for u in sorted(members)]
                pairs = ((parts[n], parts[m]) for n, m in meetings([words for _, words in parts], brief, partners)) if second else combinations(parts, 2)
                for (a, words), (b, others) in pairs:
                    if (a, b) not in out and (found := level(words, others)):
                        out[a, b] = found
            yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in out], pa.string()), pa.array([b for _, b in out], pa.string()), pa.array(list(out.values()), pa.int32())], ["a", "b", "level"])

    return cut(lists.mapInArrow(run, "a string, b string, level int").distinct())


def mentions(df: DataFrame, key: str, authors: str) -> DataFrame:
    """``key``, ``pos``, ``name``, ``orcid`` (16 characters or ''), ``affiliations`` of every author with a name."""
    rows = df.select(F.col(key), F.posexplode(authors).alias("pos", "a")).select(key, "pos", "a.name", "a.orcid", F.coalesce("a.affiliations", F.array().cast("array<string>")).alias("affiliations"))
    plain = F.upper(F.regexp_extract(F.regexp_replace("orcid", "[^0-9Xx]", ""), "([0-9]{15}[0-9Xx])$", 1))
    return rows.withColumn("orcid", F.coalesce(plain, F.lit(""))).where("trim(name) <> ''")


def organisations(people: DataFrame) -> DataFrame:
    """``name``, ``org``: every affiliation spelling and the least spelling of its organisation."""
    said = people.select("orcid", F.explode("affiliations").alias("name")).where("trim(name) <> ''")
    units = _tokenised(said, commas=True)
    pairs = suffix_pairs(units, organisation_level, 4, second=False)
    # people: of each ORCID the usual spelling, and the others it bears; a hot ORCID is reduced before anything is joined
    borne = cut(said.where("orcid <> ''").groupBy("orcid", "name").agg(F.count(F.lit(1)).alias("n")).join(units.select("name", "unit"), "name").groupBy("orcid", "unit").agg(F.sum("n").alias("n")))
    main = borne.groupBy("orcid").agg(F.max_by("unit", F.struct("n", "unit")).alias("main"))
    stars = borne.join(main, "orcid").groupBy("unit", "main").agg(F.count(F.lit(1)).alias("both"))
    total = stars.groupBy("unit").agg(F.sum("both").alias("total"))
    shared = cut(stars.where("unit <> main").join(total, "unit").where("both >= 2 AND both >= 0.4 * total"))
    # people decide only where the spellings share a word that few spellings have
    words = units.select("unit", F.explode(F.array_distinct(F.split("unit", " "))).alias("word")).distinct().groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    spellings = units.agg(F.count_distinct("unit").alias("all"))
    few = words.join(F.broadcast(spellings), F.col("df") <= F.greatest(F.lit(3), F.col("all") * RARE)).select("word")
    met = shared.select(F.least("unit", "main").alias("a"), F.greatest("unit", "main").alias("b")).join(pairs, ["a", "b"], "left_semi")
    common = met.select("a", "b", F.explode(F.array_intersect(F.split("a", " "), F.split("b", " "))).alias("word"))
    lexical = common.join(few, "word", "left_semi").select("a", "b").distinct()
    is_acronym = F.udf(lambda c, w: " " not in c and acronym(c, tuple(w.split(" "))), "boolean", useArrow=True)
    codes = shared.where(~F.col("unit").contains(" ")).where(is_acronym("unit", "main")).select(F.col("unit").alias("a"), F.col("main").alias("b"))
    links = pairs.where("level = 2").select("a", "b").union(lexical).union(codes)
    groups = components(links)
    named = units.join(groups, units.unit == groups.id, "left").select("name", F.coalesce("group", "unit").alias("group"))
    least = named.groupBy("group").agg(F.min("name").alias("org"))
    return cut(named.join(least, "group").select("name", "org"))


def bearers(units: DataFrame) -> DataFrame:
    """``word``, ``n``: in how many distinct names each word stands."""
    one = units.select("unit").distinct()
    return one.select(F.explode(F.array_distinct(F.split("unit", " "))).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def learnt_nicknames(people: DataFrame, units: DataFrame, words: DataFrame | None = None) -> frozenset[tuple[str, str]]:
    """Pairs of given names that stand for each other beside the same surnames, by people with an ORCID.

    Each ORCID compares its usual name with the others it bears, so a hot one costs one row for each name.
    The pairs are bounded by the vocabulary of given names; more than ``MOST_NICKS`` raise.
    """
    borne = cut(people.where("orcid <> ''").groupBy("orcid", "name").agg(F.count(F.lit(1)).alias("n")).join(units, "name").groupBy("orcid", "unit").agg(F.sum("n").alias("n")))
    main = borne.groupBy("orcid").agg(F.max_by("unit", F.struct(F.length("unit") > 0, "n", "unit")).alias("main"))
    both = borne.join(main, "orcid").where("unit <> main").select("orcid", F.split("unit", " ").alias("x"), F.split("main", " ").alias("y"))
    differ = both.select("orcid", F.array_except("x", "y").alias("p"), F.array_except("y", "x").alias("q"), F.size(F.array_intersect("x", "y")).alias("same"))
    single = differ.where("same > 0 AND size(p) = 1 AND size(q) BETWEEN 1 AND 2 AND length(p[0]) > 1").select("orcid", F.col("p")[0].alias("p"), F.explode("q").alias("q")).where("length(q) > 1 AND NOT contains(p, '*') AND NOT contains(q, '*')")
    two = single.select("orcid", F.least("p", "q").alias("p"), F.greatest("p", "q").alias("q"))
    counted = two.groupBy("p", "q").agg(F.count_distinct("orcid").alias("n")).where(F.col("n") >= NICK_SUPPORT)
    words = bearers(units) if words is None else words
    known = counted.join(words.select(F.col("word").alias("p"), F.col("n").alias("np")), "p").join(words.select(F.col("word").alias("q"), F.col("n").alias("nq")), "q")
    rows = known.limit(MOST_NICKS + 1).collect()
    if len(rows) > MOST_NICKS:
        raise ValueError("more nickname pairs than a vocabulary of given names can have")
    found = [(min((r.np, r.p), (r.nq, r.q))[1], r.p, r.q, r.n) for r in rows if not alike(r.p, r.q)]
    usual: dict[str, int] = {}
    for rarer, _, _, n in found:
        usual[rarer] = max(n, usual.get(rarer, 0))
    return frozenset(x for rarer, p, q, n in found if n >= NICK_SHARE * usual[rarer] for x in ((p, q), (q, p)))


def common_given(units: DataFrame, words: DataFrame | None = None) -> frozenset[str]:
    """Words that stand in at least ``GIVEN`` of all names: given names.  There are at most words-in-a-name / ``GIVEN`` of them."""
    words = bearers(units) if words is None else words
    all_units = units.agg(F.count_distinct("unit").alias("all"))
    return frozenset(r.word for r in words.join(F.broadcast(all_units), F.col("n") >= F.greatest(F.lit(15), F.col("all") * GIVEN)).where("length(word) > 2").select("word").collect())


def persons(people: DataFrame, orgs: DataFrame) -> DataFrame:
    """``name``, ``orcid``, ``org``, ``person`` of every bearer; ``person`` is an ORCID or the least bearer of its group."""
    units = _tokenised(people, commas=False)
    words = cut(bearers(units))
    nicks = learnt_nicknames(people, units, words)
    given = common_given(units, words)
    pairs = suffix_pairs(units, lambda a, b: person_level(a, b, nicks, given), given=given, nicks=nicks)
    first = people.withColumn("aff", F.coalesce(F.try_element_at("affiliations", F.lit(1)), F.lit("")))
    placed = first.join(orgs.select(F.col("name").alias("aff"), "org"), "aff", "left").withColumn("org", F.coalesce("org", F.lit("")))
    borne = cut(placed.select("name", "orcid", "org").distinct().join(units.select("name", "unit"), "name"))
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), "level"))
    same = units.select(F.col("unit").alias("a"), F.col("unit").alias("b")).distinct().withColumn("level", F.lit(3))
    near = both.unionByName(same)
    # people with an ORCID, by unit and organisation
    known = borne.where("orcid <> ''").select(F.col("unit").alias("b"), "orcid", F.col("org").alias("there")).distinct()
    loose = borne.where("orcid = ''").select(F.col("unit").alias("a"), "org").distinct()
    fits = loose.join(near, "a").join(known, "b").select("a", "org", "orcid", (F.col("level") + F.when((F.col("org") != "") & (F.col("org") == F.col("there")), 4).otherwise(0)).alias("score"))
    one = fits.groupBy("a", "org", "orcid").agg(F.max("score").alias("score"))
    # an abbreviated name of another organisation than the person's is not theirs
    seats = known.where("there <> ''").select("orcid", F.col("there").alias("org"), F.lit(True).alias("seat")).distinct()
    seated = seats.select("orcid", F.lit(True).alias("seated")).distinct()
    one = one.join(seated, "orcid", "left").join(seats, ["orcid", "org"], "left").where("score > 1 OR org = '' OR seated IS NULL OR seat")
    best = one.groupBy("a", "org").agg(F.max(F.struct("score", "orcid")).alias("top"), F.max("score").alias("high"), F.count_if(F.col("score") == 1).alias("possible"))
    # an abbreviated name without a common organisation must have one possible bearer only
    sure = cut(best.where("high >= 2 OR possible = 1").select("a", "org", F.col("top.orcid").alias("person")))
    rest = cut(loose.join(sure, ["a", "org"], "left_anti"))
    tag = lambda u, o: F.concat_ws("\x1f", u, o)
    other = rest.select(F.col("a").alias("b"), F.col("org").alias("there"))
    edges = rest.join(near, "a").join(other, "b").where("(level >= 2 OR (org = there AND org <> '')) AND (a <> b OR org <> there)").select(tag(F.col("a"), F.col("org")).alias("x"), tag(F.col("b"), F.col("there")).alias("y"))
    groups = components(edges.select(F.col("x").alias("a"), F.col("y").alias("b")))
    own = tag(F.col("unit"), F.col("org"))
    with_id = borne.where("orcid <> ''").select("name", "orcid", "org", F.col("orcid").alias("person"))
    without = borne.where("orcid = ''").join(sure.withColumnRenamed("a", "unit"), ["unit", "org"], "left").withColumn("own", own).join(groups.withColumnRenamed("id", "own"), "own", "left")
    return cut(with_id.unionByName(without.select("name", "orcid", "org", F.coalesce("person", "group", "own").alias("person"))))


def _pairs_of(members: DataFrame, group: str, name: str) -> DataFrame:
    """``name_a`` < ``name_b``: every two distinct names of a group."""
    one = members.select(group, name).distinct()
    a, b = one.select(group, F.col(name).alias("name_a")), one.select(group, F.col(name).alias("name_b"))
    return a.join(b, group).where("name_a < name_b").select("name_a", "name_b")


def name_pairs(df: DataFrame, key: str, authors: str) -> DataFrame:
    """``kind``, ``name_a`` < ``name_b``: every two spellings one person, or one organisation, bears."""
    people = cut(mentions(df, key, authors))
    orgs = organisations(people)
    who = persons(people, orgs)
    kinds: list[tuple[str, DataFrame, str]] = [("person", who, "person"), ("organisation", orgs, "org")]
    parts = [_pairs_of(rows, group, "name").withColumn("kind", F.lit(kind)) for kind, rows, group in kinds]
    return parts[0].distinct().unionByName(parts[1].distinct()).select("kind", "name_a", "name_b")


def author_persons(df: DataFrame, key: str, authors: str) -> DataFrame:
    """``key``, ``person`` of every author of every record, once each."""
    people = cut(mentions(df, key, authors))
    orgs = organisations(people)
    who = persons(people, orgs)
    aff: Column = F.coalesce(F.try_element_at("affiliations", F.lit(1)), F.lit(""))
    placed = people.withColumn("aff", aff).join(orgs.select(F.col("name").alias("aff"), "org"), "aff", "left").withColumn("org", F.coalesce("org", F.lit("")))
    return placed.join(who, ["name", "orcid", "org"]).select(key, "person").distinct()
