"""Text spoilt by a wrong character encoding: find it and restore it.

Three shapes of damage are told apart, each on whole texts:

``span``     UTF-8 bytes read in a legacy code page (once or several times over).  Every
             character is mapped back to its legacy byte, a byte-structure automaton finds
             the maximal well-formed multi-byte spans, and those spans only are decoded.
``swap``     text of one single-byte code page read in another.  No multi-byte structure is
             left, so the characters are mapped back to bytes and read in each known page;
             the reading that leaves only ordinary letters in every damaged word wins.
``loss``     replacement characters or question marks for letters: found, not restorable.

Null and empty texts are clean and come back unchanged.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Code pages in which UTF-8 bytes may have been read, most usual first.
LEGACY_PAGES = ("cp1252", "mac_roman", "cp1250", "cp1251", "cp850", "cp437", "cp1254", "cp852", "iso8859_15", "cp866", "koi8_r")
#: Pages tried as the true and as the wrong one of single-byte text.
SINGLE_BYTE_PAGES = ("cp1252", "mac_roman", "cp850", "cp437", "cp1250", "cp1251", "cp1254", "cp852", "koi8_r", "iso8859_2", "iso8859_5")

#: The letters beyond ASCII of Portuguese, Spanish, English, French and German.
WESTERN_LETTERS = "áàâãäåæçéèêëíìîïñóòôõöøœúùûüýÿßÁÀÂÃÄÅÆÇÉÈÊËÍÌÎÏÑÓÒÔÕÖØŒÚÙÛÜÝŸ"
#: Letters of those languages as they occur in running text; a swap must end in these.
COMMON_LETTERS = "áàâãäçéèêëíîïñóôõöúùûüßœÁÀÂÃÄÇÉÈÊÍÎÑÓÔÕÖÚÛÜ"
def _page_bytes(page: str) -> dict[str, int]:
    """Character to byte, for the bytes from 0x80; undefined bytes stand for themselves."""
    table: dict[str, int] = {}
    for byte in range(0x80, 0x100):
        try:
            table[bytes([byte]).decode(page)] = byte
        except UnicodeDecodeError:
            pass
    if page in ("cp1252", "cp1250", "cp1251", "cp1254"):
        for byte in range(0x80, 0x100 if page == "cp1252" else 0xA0):
            table.setdefault(chr(byte), byte)
    return table


_TO_BYTE = {page: _page_bytes(page) for page in LEGACY_PAGES}
_ACCEPT, _REJECT = 0, 9


def _automaton() -> list[list[int]]:
    """Transition table of well-formed UTF-8: state x byte to state.  State 0 is between
    characters, 1 to 3 wait for so many continuation bytes, 4 to 7 are the restricted second
    bytes after E0, ED, F0 and F4, and 9 is the dead state."""
    dead = [_REJECT] * 256
    table = [dead[:] for _ in range(10)]
    for b in range(0x80):
        table[0][b] = 0
    for b in range(0xC2, 0xE0):
        table[0][b] = 1
    for b in range(0xE0, 0xF0):
        table[0][b] = 2
    for b in range(0xF0, 0xF5):
        table[0][b] = 3
    table[0][0xE0], table[0][0xED], table[0][0xF0], table[0][0xF4] = 4, 5, 6, 7
    for b in range(0x80, 0xC0):
        table[1][b], table[2][b], table[3][b] = 0, 1, 2
        table[4][b] = 1 if b >= 0xA0 else _REJECT
        table[5][b] = 1 if b < 0xA0 else _REJECT
        table[6][b] = 2 if b >= 0x90 else _REJECT
        table[7][b] = 2 if b < 0x90 else _REJECT
    return table


_DFA = _automaton()


def well_formed_spans(data: list[int]) -> list[tuple[int, int]]:
    """Maximal spans of complete multi-byte characters in a run of bytes from 0x80 up."""
    spans: list[tuple[int, int]] = []
    at, n = 0, len(data)
    while at < n:
        state, end, pos = 0, at, at
        while pos < n:
            state = _DFA[state][data[pos]]
            if state == _REJECT:
                break
            pos += 1
            if state == _ACCEPT:
                end = pos
        if end > at:
            spans.append((at, end))
            at = end
        else:
            at += 1
    return spans


def _assigned(ch: str) -> bool:
    return "\x80" <= ch < "\xa0" or unicodedata.category(ch) not in ("Cc", "Cn", "Co", "Cs")


def _plausible(got: str) -> list[bool]:
    """Of each character decoded: European letters, marks, signs and the loss sign always,
    others assigned only beside each other or from four bytes, as a clean letter and two signs may form one."""
    alone = [_assigned(c) and (o < 0x530 or 0x1E00 <= o <= 0x27BF or 0xFB00 <= o <= 0xFB06 or o in (0xFEFF, 0xFFFD) or o > 0xFFFF) for c in got for o in (ord(c),)]
    return [ok or (_assigned(c) and any(not alone[k] and _assigned(got[k]) for k in (n - 1, n + 1) if 0 <= k < len(got))) for n, (c, ok) in enumerate(zip(got, alone, strict=True))]


#: Opening quotes of each closing mark.
_OPENING = {"”": "“", "“": "„", "’": "‘", "‘": "‚", "»": "«"}
_FINAL_TILDE = re.compile(r"(?:MANH|IRM|MAÇ|CRIST|ROM|ALEM|CIDAD|ÓRF|HORTEL|AVEL|CAMPE|\b[LFVS]|\bAN)$")


def _closes(text: str, start: int) -> bool:
    """Whether the capital at ``start`` ends a clean word and the mark after it stands for itself:
    Ã does so after its opening quote in the text node or in a word that ends in Ã, others always."""
    if text[start] != "Ã":
        return True
    node = text[max(text.rfind(">", 0, start), text.rfind("<", 0, start)) + 1 : start]
    mark = text[start + 1]
    return node.count(_OPENING.get(mark, mark)) > (node.count(mark) if mark in _OPENING else len(node)) or _FINAL_TILDE.search(node) is not None


def _layer(text: str, page: str) -> tuple[str, int]:
    """Decode the well-formed spans of one page; how many characters came out."""
    table, out, at, made = _TO_BYTE[page], [], 0, 0
    for run in _RUN[page].finditer(text):
        chars = run.group()
        data = [table[c] for c in chars]
        for a, b in well_formed_spans(data):
            got = bytes(data[a:b]).decode("utf-8")
            good = _plausible(got)
            if not any(good):
                continue
            start, end = run.start() + a, run.start() + b
            before, after = text[start - 1 : start], text[end : end + 1]
            if page == "cp1251" and (_CYRILLIC.match(before) or _CYRILLIC.match(after)):
                continue  # inside a Cyrillic word
            if page in ("cp1252", "cp1254", "iso8859_15", "cp1250") and b - a == 2 and chars[b - 1] in "”“’‘»—–…" and before.isupper() and not after.isalpha() and _closes(text, start):
                continue  # a capital letter and a closing mark
            out.append(text[at:start])
            # an implausible character does not spoil its neighbours: it stays as it is
            pos = start
            for c, ok in zip(got, good, strict=True):
                out.append(c if ok else text[pos : pos + len(c.encode())])
                pos += len(c.encode())
            at, made = end, made + sum(good)
    out.append(text[at:])
    return ("".join(out), made) if made else (text, 0)


#: Lead and continuation byte of any one page; a text without such neighbours has no span.
_PAIRS = {a + b for t in _TO_BYTE.values() for a, m in t.items() if 0xC2 <= m < 0xF5 for b, n in t.items() if n < 0xC0}
_HIGH_RUN = re.compile("[^\x00-\x7f]{2,}")


def _may_have_span(text: str) -> bool:
    return any(r[i : i + 2] in _PAIRS for r in set(_HIGH_RUN.findall(text)) for i in range(len(r) - 1))


_CYRILLIC = re.compile("[Ѐ-ӿ]")
_RUN = {page: re.compile("[" + "".join(map(re.escape, sorted(t))) + "]{2,}") for page, t in _TO_BYTE.items()}

_LETTER = "A-Za-z" + WESTERN_LETTERS
#: Damage that no clean word of the five languages shows; each alternative is one structural test.
_DAMAGE = re.compile(
    "[\x80-\x9f─-▟]"
    rf"|[{_LETTER}][^\sA-Za-z0-9{WESTERN_LETTERS}\x00-\x7e’‐‑–—°ªº·\xad\xa0​-‏⁠﻿̀-ͯ“”«»…ʼﬀ-ﬆ！-～][{_LETTER}]"
    rf"|[a-z{COMMON_LETTERS[:27]}][ÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖØÙÚÛÜÝÞ][a-z]"
    r"|[a-z][¢£¤¥§¨¯´¶¸¾ƒŽžŠšŸ‚„†‡ˆ˜‰‹›ˇ˘˙˛∑√∫≈≠∞ÆØÞÐ](?![A-Za-z])"
    r"|[0-9] ?[^\x00-\x7e°º\xa0]C\b"
    r"|[A-Za-z][þðıłŁśťžŽšŠşŞżĂăĽľŤŚŹźĺŕŘřŮůŰűŐőĎďČčĚěŇňİğĞ][a-z]"
    rf"|[А-Яа-яЂ-џѐ-ѯҐґ][{_LETTER}]|[{_LETTER}][А-Яа-яЂ-џѐ-ѯҐґ]"
)
#: Single-byte swaps that show only as signs or letters of clean text: by the words they stand in.
_QUIET = re.compile(
    r"[a-zñ]—(?:n|nic[ao]s?|gic[ao]s?|mic[ao]s?|ric[ao]s?|lic[ao]s?|tic[ao]s?|sitos?|stic[ao]s?)(?!\w)"  # ó
    r"|\b[Aa]–[oa]s?(?!\w)|(?:[Ss]e|[Nn]i|[Mm]a|[Ee]nse|[Tt]ama|[Pp]eque|[Ee]spa|[Mm]onta|[Cc]ampa|[Cc]ompa|[Oo]to|[Dd]esempe)–[a-z]"  # ñ
    r"|[a-z]{2}’(?:nic[ao]|tic[ao]|fic[ao]|mic[ao]|sic[ao]|ric[ao]|lic[ao]|stic[ao]|odo|cul[ao]|mite|nea|ses|ndice)s?(?!\w)|[a-z]{3}’(?:as?|os?|an)(?!\w)"  # í
    rf"|[{_LETTER}]·(?<![lL]·)[{_LETTER}]|[{_LETTER}]·(?![lL])[{_LETTER}]"  # á, but not the Catalan l·l
    r"|[b-df-hj-np-tv-xzB-DF-HJ-NP-TV-XZ]ß[a-z]"  # á: no German ß follows a consonant
)
_QUIET_PAGES = {"—": ("cp1252", "mac_roman"), "–": ("cp1252", "mac_roman"), "’": ("cp1252", "mac_roman"), "·": ("mac_roman", "cp1252"), "ß": ("cp437", "cp1252")}
#: Question marks in place of letters and signs.  One mark between a word and a blank is an ordinary question.
_LOSS = re.compile(
    r"�|[^\W\d_]\?+[^\W\d_]"  # inside a word, capitals too
    r"|[0-9] \?+ [0-9]|[0-9] ?\?+C\b"  # plus-minus and degree signs
    r"|[^\W\d_]\?{2,}(?= [^\W\d_])"  # a run after a word in mid-sentence
    r"|(?<![^\s>(])\?+[^\W\d_]"  # first letter
    r"|[^\W\d_]\?+(?=</(?:given-names|surname|kwd)>|,? [A-Z]\w*</(?:given-names|surname)>)"  # last letter of a name or keyword
)
_QUIET_SIGN = re.compile("[—–’·ß]")
_ODD_RUN = re.compile("[^\x00-\x7e]+")


@lru_cache(1 << 15)
def _damaged_piece(piece: str) -> bool:
    return _DAMAGE.search(piece) is not None


@lru_cache(1 << 15)
def _quiet_piece(piece: str) -> bool:
    return _QUIET.search(piece) is not None


def _damaged(text: str) -> bool:
    """Whether _DAMAGE matches; a match lies within four characters of a run beyond ASCII."""
    return any(map(_damaged_piece, {text[max(0, m.start() - 4) : m.end() + 4] for m in _ODD_RUN.finditer(text)}))


def _quiet(text: str) -> bool:
    """Whether _QUIET matches; a match lies within twelve characters of its sign."""
    return any(map(_quiet_piece, {text[max(0, m.start() - 12) : m.end() + 12] for m in _QUIET_SIGN.finditer(text)}))


_MARKS = re.compile(r"\?+")


def _lost(text: str) -> bool:
    """Whether _LOSS matches; it is tried around the marks only."""
    return "�" in text or any(_LOSS.search(text[max(0, m.start() - 3) : m.end() + 80]) for m in _MARKS.finditer(text))


_URL = re.compile(r"https?://[^\s<>\"']+|\b10\.\d{4,}/[^\s<>\"']+")


def swap_pages(text: str) -> tuple[str, str] | None:
    """(wrong page, true page) that mends nearly every odd character of the damaged words."""
    odd: dict[str, int] = {}
    for m in _WORDS.finditer(text):  # each word once, so unspaced text costs no more than spaced
        hits = sum(1 for _ in _DAMAGE.finditer(m.group()))
        for c in m.group() if hits else ():
            if ord(c) > 0x7E and c not in COMMON_LETTERS and c not in "–—’“”«»±":
                odd[c] = odd.get(c, 0) + hits
    for m in _DEGREES.finditer(text):
        for c in m.group():
            if ord(c) > 0x7E and c not in COMMON_LETTERS:
                odd[c] = odd.get(c, 0) + 1
    total = sum(odd.values())
    best, most = None, (0.0, 0)
    for wrong in SINGLE_BYTE_PAGES if total else ():
        for true in SINGLE_BYTE_PAGES:
            if true == wrong:
                continue
            back = {c: _SWAP_CHARS[true].get(_SWAP_BYTES[wrong].get(c, -1), "") for c in odd}
            letters = sum(n for c, n in odd.items() if back[c] and back[c] in COMMON_LETTERS)
            small = sum(n for c, n in odd.items() if back[c] and back[c] in COMMON_LETTERS and back[c].islower())
            signs = sum(n for c, n in odd.items() if back[c] and back[c] in "°±¿¡«»“”’—–ºª")
            if letters and letters + signs >= 0.9 * total and (letters + 0.5 * signs, small) > most:
                best, most = (wrong, true), (letters + 0.5 * signs, small)
    return best


def swap_read(text: str, pages: tuple[str, str]) -> str:
    """Read text of the wrong page in the true one, where that gives letters or usual signs."""
    table, chars = _SWAP_BYTES[pages[0]], _SWAP_CHARS[pages[1]]
    return "".join(got if ord(c) > 0x7E and (got := chars.get(table.get(c, -1), "")) and got in COMMON_LETTERS + "°±¿¡«»“”’—–ºª" else c for c in text)


_SWAP_BYTES = {p: _page_bytes(p) for p in SINGLE_BYTE_PAGES}
_SWAP_CHARS = {p: {b: c for c, b in t.items()} for p, t in _SWAP_BYTES.items()}


_WORDS = re.compile(r"[^ \t\r\n<>]+")  # a no-break space may be a spoilt letter
#: The one damage that lies between words: a temperature's sign.
_DEGREES = re.compile("[0-9] [^\x00-\x7e°º\xa0]C\\b")
def _reread(text: str, pages: tuple[str, str]) -> str:
    """Spoilt words read in the true page.

    A word that shows no damage is read anew only if that makes no capital of a small letter and no
    damage: 'saœde' gives 'saúde', but 'média' stays, which would give 'mÚdia'.
    """

    def word(m: re.Match[str]) -> str:
        old = m.group()
        new = swap_read(old, pages)
        if old == new or _DAMAGE.search(old):
            return new
        worse = any(a.islower() and b.isupper() and (n or len(old) == 1 or a not in "çœµßÿø") for n, (a, b) in enumerate(zip(old, new, strict=True))) or _DAMAGE.search(new)
        return old if worse else new

    return _WORDS.sub(word, text)


def repair(text: str | None) -> tuple[str | None, str]:
    """(text restored as far as possible, damage found: '' or a list of span, swap, loss)."""
    if not text:
        return text, ""
    kinds, now = [], text
    if not text.isascii():
        while _may_have_span(now):  # every pass shortens the text
            best, most = now, 0
            for page in LEGACY_PAGES:
                got, made = _layer(now, page)
                if made > most:
                    best, most = got, made
            if not most:
                break
            now = best
            if "span" not in kinds:
                kinds.append("span")
        plain = _URL.sub(" ", now)
        if _damaged(plain):
            kinds.append("swap")
            pages = swap_pages(now)
            pieces = re.split("(<[^>]*>)", now)  # only the spoilt elements are read anew
            now = "".join(_reread(p, own) if p and p[0] != "<" and _DAMAGE.search(p) and (own := pages or swap_pages(p)) else p for p in pieces)
            plain = _URL.sub(" ", now)
        if _quiet(plain):
            if "swap" not in kinds:
                kinds.append("swap")
            now = _QUIET.sub(lambda m: "".join(swap_read(c, _QUIET_PAGES[c]) if c in _QUIET_PAGES else c for c in m.group()), now)
            plain = _URL.sub(" ", now)
    else:
        plain = _URL.sub(" ", now) if "?" in now else now
    if ("?" in plain or "�" in plain) and _lost(plain):
        kinds.append("loss")
    return now, ",".join(kinds)


#: What every text that repair() could find anything in has: a character beyond ASCII or a question mark.
SUSPECT = r"[^\x00-\x7e]|\?"


def suspect(text: Column) -> Column:
    """Cheap exact prefilter: false only where repair() finds nothing."""
    return F.coalesce(text.rlike(SUSPECT), F.lit(False))


def repair_texts(df: DataFrame, key: str, text: str) -> DataFrame:
    """``key``, ``restored``, ``damage`` of every row whose text is spoilt; clean rows give none."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, restored, damage = [], [], []
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                got, kinds = repair(t)
                if kinds:
                    keys.append(k)
                    restored.append(got)
                    damage.append(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(keys, batch.schema.field(0).type), pa.array(restored, pa.string()), pa.array(damage, pa.string())], ["__key", "restored", "damage"])

    picked = df.select(F.col(key).alias("__key"), F.col(text).alias("__text")).where(suspect(F.col("__text")))
    return picked.mapInArrow(run, f"__key {kind}, restored string, damage string").withColumnRenamed("__key", key)
