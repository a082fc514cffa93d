"""Garbled text from wrong character encodings: found, and restored by a best-first search.

A state is a text; its operations are: undo a reading (encode with the encoding it was read in, decode
with the one it was written in), unescape character references, and turn the case of lead letters back
where a garbled text was lower- or upper-cased. States are expanded cheapest first, a hash of each is
visited once, and the cost is how implausible the characters and their neighbours are. Readings of UTF-8
change runs of characters beyond ASCII only, so each distinct run is searched alone and to the end, and the
path that gains most over the runs of a line is taken; readings of one single-byte or Asian encoding as another are undone for whole
sentences of six foreign characters or more, for runs of three foreign characters or more alone, and for single words that hold a sign which no right word has.

A garbled a-grave or no-break space whose second character became a blank is one letter that stands alone;
it is taken back by the blanks after it.

Cases: null, empty and ASCII texts without character references are not affected; texts that only quote
garbled characters aren't either; where characters were lost (replacement characters) the text is
affected and only what can be restored is; an odd sign in a word that no reading explains is affected and
stays; a capital between small letters is affected only if a reading explains it, as names in code have it; very long texts are taken whole, piece by piece; repeated
rows are found alike; no rows give no rows; other columns aren't read.
"""

from __future__ import annotations

import codecs
import heapq
import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import spread

# Classes of characters.
PLAIN, LOWER, UPPER, ACC_LOW, ACC_UP, EXT_LOW, EXT_UP, CYR_LOW, CYR_UP, CYR_RARE, GREEK, KANA, HAN, HALF, OPENER, CLOSER, SYMBOL, QUOTE, TYPO, BOX, CONTROL, LOST, MATH, OTHER, NBSP, RARE = range(26)
LETTERS = (LOWER, UPPER, ACC_LOW, ACC_UP, EXT_LOW, EXT_UP, CYR_LOW, CYR_UP, CYR_RARE)
LATIN = (LOWER, UPPER, ACC_LOW, ACC_UP, EXT_LOW, EXT_UP)
#: Cost of one character of each class.
SINGLE = [0, 0, 0, 1, 1, 2.5, 2.5, 0, 0, 4, 2, 0.4, 0.8, 4, 1, 1, 1.5, 0.7, 2, 2, 10, 8, 1.5, 1, 1, 9]
#: Russian letters from frequent to rare; the cost rises along the line.
RUSSIAN = "оеаинтсрвлкмдпуяыьгзбчйхжшюцщэфъё"
#: Accented letters that do follow each other in words.
PAIRS = {"çã", "çõ", "éé", "öß", "üß", "äß", "íó", "ãê", "ÇÃ", "ÇÕ", "ÉÉ", "ñí", "óñ", "úñ", "ñú", "ñó"}


def _classes() -> tuple[np.ndarray, np.ndarray]:
    kind = np.full(0x10000, OTHER, np.uint8)
    kind[:128] = PLAIN
    kind[ord("a") : ord("z") + 1], kind[ord("A") : ord("Z") + 1] = LOWER, UPPER
    kind[0x80:0xA0], kind[0x85] = CONTROL, PLAIN
    kind[0xA0:0xC0] = SYMBOL
    for c in "¿¡«µ°§©£¥±¶½¼¾":
        kind[ord(c)] = OPENER
    for c in "»®²³¹":
        kind[ord(c)] = CLOSER
    kind[0xA0], kind[0xAD] = NBSP, TYPO
    for c in range(0xC0, 0x180):
        low = chr(c).islower()
        kind[c] = (ACC_LOW if low else ACC_UP) if c < 0x100 or chr(c) in "œŒŸ" else (EXT_LOW if low else EXT_UP)
    kind[0xD7] = kind[0xF7] = MATH
    kind[0x180:0x2000] = RARE
    kind[0x27C0:0x3000] = kind[0xA000:0xD800] = RARE
    kind[0x300:0x30D] = kind[0x327:0x329] = OTHER
    kind[0x370:0x400] = GREEK
    kind[0x400:0x460] = CYR_RARE
    kind[0x410:0x430], kind[0x430:0x450] = CYR_UP, CYR_LOW
    kind[0x401], kind[0x451] = CYR_UP, CYR_LOW
    for c in "‘’“”–—…•":
        kind[ord(c)] = QUOTE
    for c in "‚„†‡ˆ˜‰‹›€™ƒ¸ˇ˘˝˙":
        kind[ord(c)] = TYPO
    kind[0x2100:0x2460] = MATH
    kind[ord("™")], kind[ord("№")] = CLOSER, OPENER
    kind[0x2500:0x25A0] = BOX
    for c in "⌐⌠⌡":
        kind[ord(c)] = BOX
    kind[0x3000:0x3040], kind[0x3040:0x3100], kind[0x3400:0xA000], kind[0xFF00:0xFF61], kind[0xFF61:0xFFA0] = HAN, KANA, HAN, HAN, HALF
    kind[0xFFFD], kind[0xD800:0xE000], kind[0xE000:0xF900] = LOST, OTHER, CONTROL
    single = np.array(SINGLE, np.float32)[kind]
    for k, letter in enumerate(RUSSIAN):
        single[ord(letter)] = single[ord(letter.upper())] = 0.25 + 1.5 * (k / len(RUSSIAN)) ** 1.5
    single[0x410:0x430] += 0.1
    return kind, single


def _neighbours() -> np.ndarray:
    """Cost of a character of one class right before one of another."""
    cost = np.zeros((26, 26), np.float32)
    for a in LETTERS:
        cost[a, [SYMBOL, OPENER, TYPO, BOX, CONTROL, HALF]] = 3
        cost[a, CLOSER] = 1
        cost[a, MATH] = 2
        cost[[SYMBOL, CLOSER, TYPO, BOX, HALF, MATH], a] = 2
        cost[a, LOST] = cost[LOST, a] = 1
    cost[[ACC_UP, ACC_LOW, EXT_UP, EXT_LOW], NBSP] = 2
    cost[ACC_UP, CLOSER] = cost[ACC_UP, QUOTE] = cost[ACC_LOW, CLOSER] = 3
    cost[[LOWER, ACC_LOW, EXT_LOW], ACC_UP] = cost[[LOWER, ACC_LOW, EXT_LOW], EXT_UP] = 3
    accented = [ACC_LOW, ACC_UP, EXT_LOW, EXT_UP]
    for a in accented:
        cost[a, accented] += 2
    cost[CYR_LOW, CYR_UP] = 3
    for a in LATIN:
        cost[a, [CYR_LOW, CYR_UP, CYR_RARE]] = cost[[CYR_LOW, CYR_UP, CYR_RARE], a] = 4
        cost[a, GREEK] = cost[GREEK, a] = 3
    for a in (CYR_LOW, CYR_UP, CYR_RARE):
        cost[a, [SYMBOL, TYPO, BOX, OPENER, NBSP]] = 3
        cost[a, GREEK] = cost[GREEK, a] = 3
    for a in (ACC_LOW, ACC_UP, EXT_LOW, EXT_UP, CYR_LOW, CYR_UP, CYR_RARE, SYMBOL, TYPO, GREEK, BOX, MATH, RARE):
        cost[a, [KANA, HAN]] = cost[[KANA, HAN], a] = 3
    for a in (LOWER, UPPER):  # a program's name stands beside kana, but not on both sides
        cost[a, [KANA, HAN]] = cost[[KANA, HAN], a] = 1.5
    cost[CYR_LOW, NBSP] = cost[CYR_UP, QUOTE] = 1
    cost[np.ix_([GREEK, MATH, BOX], [SYMBOL, TYPO])] = 2
    cost[BOX, [OPENER, CLOSER, MATH, GREEK, ACC_LOW, ACC_UP]] = 3
    for a in (SYMBOL, TYPO, GREEK, MATH):
        cost[a, [SYMBOL, TYPO, OPENER, CLOSER, BOX]] = 2
        cost[[OPENER, CLOSER, BOX], a] = 2
    cost[MATH, OPENER] = cost[GREEK, QUOTE] = cost[MATH, QUOTE] = 2
    return cost


KIND, ALONE = _classes()
BESIDE = _neighbours()
ACCENTED = np.isin(np.arange(26), [ACC_LOW, ACC_UP, EXT_LOW, EXT_UP])


_KINDS, _ALONE, _BESIDE = KIND.tobytes(), ALONE.tolist(), BESIDE.tolist()


def costs(text: str) -> tuple[float, float]:
    """How implausible a text's characters are alone, and beside each other; plain ASCII costs nothing.

    Signs and blanks of ASCII cost nothing beside others, so a run of other characters is judged with its neighbours alone.
    """
    if len(text) > 200 or max(text, default="") > "\uffff":
        return _long_costs(text)
    alone = beside = 0.0
    before = PLAIN
    row = _BESIDE[PLAIN]
    accent_before = han = False
    kana = False
    for i, char in enumerate(text):
        code = ord(char)
        kind = _KINDS[code]
        if kind or before:
            alone += _ALONE[code]
            beside += row[kind]
            accent = ACC_LOW <= kind <= EXT_UP
            if accent and accent_before and text[i - 1 : i + 1] in PAIRS:
                beside -= 2.0
            accent_before = accent
            han, kana = han or kind == HAN, kana or kind == KANA
            before, row = kind, _BESIDE[kind]
    if han and not kana:
        alone += 3.0 * sum(_KINDS[ord(c)] == HAN for c in text)
    if "&" in text:
        alone += 3.0 * text.count("&#")
    return alone, beside


def _long_costs(text: str) -> tuple[float, float]:
    codes = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    if int(codes.max()) > 0xFFFF:
        emoji = (codes > 0xFFFF) & (codes >= 0x1F000) & (codes <= 0x1FAFF)
        rare = (codes > 0xFFFF) & ~emoji
        codes = np.where(emoji, 0x2700, np.where(rare, 0x2C00, codes))  # stand for their classes
    kinds = KIND[codes]
    alone = float(ALONE[codes].sum())
    beside = float(BESIDE[kinds[:-1], kinds[1:]].sum())
    accents = ACCENTED[kinds]
    accents = accents[:-1] & accents[1:]
    beside -= sum(2.0 for i in np.flatnonzero(accents) if text[i : i + 2] in PAIRS)
    han = int((kinds == HAN).sum())
    if han and not (kinds == KANA).any():
        alone += 3.0 * han
    return alone + 3.0 * text.count("&#"), beside


def cost(text: str) -> float:
    return sum(costs(text))


def _sloppy(encoding: str) -> dict[str, int]:
    """char -> byte; bytes without a character stand for the control of the same number, as browsers read them."""
    table = {}
    for b in range(256):
        try:
            table[bytes([b]).decode(encoding)] = b
        except UnicodeDecodeError:
            table.setdefault(chr(b), b)
    return table


#: Each operation costs a little, so that of equally plausible texts the nearer wins.
STEP = 0.25
#: Encodings that texts are read in by mistake, and, for whole sentences, pairs (read in, written in).
READ_AS = ("cp1252", "latin-1", "cp1251", "mac_roman", "cp437", "cp850", "cp866", "cp1250", "iso8859-15", "cp1254", "koi8-r", "iso8859-2", "iso8859-5", "mac_cyrillic", "cp852")
CONFUSED = (
    *((r, w) for r in ("cp1252", "latin-1", "mac_roman", "cp437", "cp850", "cp1250", "iso8859-15") for w in ("cp1251", "koi8-r", "cp866", "shift_jis", "euc_jp", "iso8859-5", "mac_cyrillic")),
    *((r, w) for r in ("cp1251", "koi8-r", "cp866", "iso8859-5", "mac_cyrillic") for w in ("cp1251", "koi8-r", "cp866", "iso8859-5", "mac_cyrillic", "shift_jis", "euc_jp") if r != w),
    *((r, w) for r in ("mac_roman", "cp437", "cp850", "cp1250", "cp1251") for w in ("cp1252",)),
    *((r, w) for r in ("cp1252", "latin-1") for w in ("mac_roman", "cp437", "cp850", "cp1250")),
)
CONFUSIONS: dict[str, list[str]] = {}
for _read, _written in CONFUSED:
    CONFUSIONS.setdefault(_read, []).append(_written)
#: The same for texts that were read in an Asian encoding.
READ_AS_ASIAN = (("cp932", ("utf-8", "euc_jp")), ("gbk", ("utf-8", "cp932", "euc_jp")), ("euc_jp", ("utf-8", "cp932")))
ASIAN = re.compile("[\u3000-\u30ff\u3400-\u9fff\uff00-\uff9f]{2}")
STRAY_CONTROL = re.compile("[\x80-\x84\x86-\x9f]")
TABLES = {name: _sloppy(name) for name in {*READ_AS, *(r for r, _ in CONFUSED)}}
LEADS = re.compile("[à-þ](?=[^\x00-\x7fa-zà-þ]|[š-žœÿƒ])")
LEADS_UP = re.compile("[À-Þ](?=[^\x00-\x7fA-ZÀ-Þ])")
_CASE_BACK = {ord("ÿ"): "Ÿ", ord("š"): "Š", ord("œ"): "Œ", ord("ž"): "Ž"}


def _bytes(text: str, encoding: str) -> bytes | None:
    try:
        return text.encode(encoding)
    except UnicodeEncodeError:
        if not STRAY_CONTROL.search(text):
            return None
    table = TABLES[encoding]
    try:
        return bytes([table[c] for c in text])
    except KeyError:
        return None


def _kept_lost(error: UnicodeError) -> tuple[bytes, int]:
    """Lost characters as a byte that no encoding has, so that they stay lost."""
    if isinstance(error, UnicodeEncodeError) and set(error.object[error.start : error.end]) == {"�"}:
        return b"\xff" * (error.end - error.start), error.end
    raise error


codecs.register_error("recordmill.lost", _kept_lost)


def _asian_steps(text: str) -> Iterator[tuple[str, bool, float]]:
    for read, written_in in READ_AS_ASIAN:
        try:
            raw = text.encode(read, "recordmill.lost")
        except UnicodeEncodeError:
            continue
        for written in written_in:
            better = raw.decode(written, "replace")
            if better.count("�") * (10 if written != "utf-8" else 3) <= len(FOREIGN.findall(better)) and better != text:
                yield better, True, STEP


def _utf8_pattern(encoding: str) -> re.Pattern:
    """The UTF-8 sequences as they look when read in an encoding."""
    shown: dict[int, str] = {b: c for c, b in TABLES[encoding].items()}

    def some(lo: int, hi: int) -> str:
        return "[" + "".join(re.escape(shown[b]) for b in range(lo, hi + 1) if b in shown) + "]"

    tail = some(0x80, 0xBF)
    return re.compile(f"{some(0xC2, 0xDF)}{tail}|{some(0xE0, 0xEF)}{tail}{{2}}|{some(0xF0, 0xF4)}{tail}{{3}}")


SEQUENCES = {name: _utf8_pattern(name) for name in READ_AS}


def _forms(text: str) -> list[str]:
    """A text and, where its letters show that its case was changed, the text with the case of lead letters turned back."""
    forms = [text]
    if LEADS.search(text):  # a lower-cased garbled text
        forms.append(LEADS.sub(lambda m: m.group().upper(), text))
        forms.append(forms[-1].translate(_CASE_BACK))
    if LEADS_UP.search(text):  # an upper-cased one
        forms.append(LEADS_UP.sub(lambda m: m.group().lower(), text))
    return forms


def _decoded(encoding: str, text: str, fresh: bytes) -> tuple[str, bytes] | None:
    """(text, fresh) with all sequences of fresh characters decoded; None if there is none.

    Only what is UTF-8 is decoded, so right characters beside garbled ones stay; ``fresh`` marks the characters
    that the last reading made.
    """
    table, out, marks, end = TABLES[encoding], [], bytearray(), 0
    for m in SEQUENCES[encoding].finditer(text):
        a, b = m.span()
        if 0 in fresh[a:b]:
            continue
        try:
            char = bytes([table[c] for c in m.group()]).decode("utf-8")
        except UnicodeDecodeError:
            continue
        out += [text[end:a], char]
        marks += bytes(a - end)
        marks.append(1)
        end = b
    if not end:
        return None
    out.append(text[end:])
    marks += bytes(len(text) - end)
    return "".join(out), bytes(marks)


def _alone_cost(char: str) -> float:
    return _ALONE[ord(char)] if char <= "\uffff" else 0.0


#: Stands for unescaped references in a path.
UNESCAPED = "&"


def readings(text: str) -> dict[tuple[str, ...], tuple[float, float, str]]:
    """Of every way to undo readings of UTF-8: (how much less the text then costs, price, text).

    Best-first search until no state is left. Each reading undoes a part of what the one before it made, so a
    path is one that the same characters took; other characters of the text are looked at again when these are
    right. Every reading shortens its part, so there are finitely many states. What a reading left as it was stays
    so on its path; a path on which that alone costs more than the cheapest text can't get better than it.
    """
    first = lowest = cost(text)
    heap, count = [(first, 0, 0.0, text, b"\1" * len(text), ())], 0
    visited = {hash((text, heap[0][4]))}
    out: dict[tuple[str, ...], tuple[float, float, str]] = {}
    baseline = first
    while heap:
        _, _, paid, now, fresh, path = heapq.heappop(heap)
        if path and paid + STEP + sum(_alone_cost(c) for c, f in zip(now, fresh, strict=True) if not f) > lowest:
            continue
        following = []
        if (not path or path[-1] == UNESCAPED) and "&" in now and (plain := html.unescape(now)) != now:
            following.append((plain, b"\1" * len(plain), (UNESCAPED,), STEP))
        for f, form in enumerate(_forms(now)):
            for k, name in enumerate(READ_AS):
                if (changed := _decoded(name, form, fresh)) is not None:
                    following.append((*changed, (*path, name), STEP + 0.05 * k + (STEP if f else 0)))
        for later, marks, steps, price in following:
            value = cost(later)
            if steps[-1] == UNESCAPED:
                baseline = min(baseline, value + paid + price)
            elif steps not in out or value + paid + price < out[steps][0] + out[steps][1]:
                out[steps] = (value, paid + price, later)
                lowest = min(lowest, value + paid + price)
            state = hash((later, marks))
            if state not in visited:
                visited.add(state)
                count += 1
                heapq.heappush(heap, (value + paid + price, count, paid + price, later, marks, steps))
    return {path: (baseline - value, price, later) for path, (value, price, later) in out.items() if value + price < baseline}


def _confused_steps(text: str) -> Iterator[tuple[str, bool, float]]:
    """The same for one single-byte or Asian encoding read as another."""
    for read, written_in in CONFUSIONS.items():
        raw = _bytes(text, read)
        for written in written_in if raw is not None else ():
            lenient = raw.decode(written, "replace")
            if lenient.count("�") * 10 <= len(lenient) and lenient.count("\x85") <= text.count("\x85"):
                yield lenient, True, STEP
    if ASIAN.search(text):
        yield from _asian_steps(text)
    if "&" in text and (plain := html.unescape(text)) != text:
        yield plain, False, STEP


def plausible(text: str) -> bool:
    """Whether a text's characters cost no more than those of right text do, and none is odd beside another."""
    alone, beside = costs(text)
    return beside <= 0 and alone <= (0.68 if CYRILLIC.search(text) else 1.05) * len(FOREIGN.findall(text)) + 0.5


#: States that cost so much more than the text itself are no way to a cheaper one.
DEAREST = 3.0
#: Readings of encodings other than UTF-8 that a text can have gone through.
CONFUSED_TWICE = 2
#: What a second such reading costs: some 3,600 pairs of them explain by chance what none of 60 does.
SECOND_STEP = 4.0


def search(text: str) -> tuple[str, float]:
    """(cheapest reachable text, how much it costs less than what no undone reading is needed for).

    Best-first until a plausible text is the cheapest or no state is left.
    """
    first = cost(text)
    heap = [(first, 0, 0.0, text, 0)]
    visited = {hash((text, False))}
    best, best_cost, baseline = text, first, first
    count = 0
    while heap:
        _, _, paid, now, undone = heapq.heappop(heap)
        for following, undid, price in _confused_steps(now):
            price = SECOND_STEP if undone and undid else price
            state = hash((following, bool(undone or undid)))
            if state in visited:
                continue
            visited.add(state)
            value = cost(following) + paid + price
            if not (undone or undid):
                baseline = min(baseline, value)
            elif value < best_cost:
                best, best_cost = following, value
            if value <= first + DEAREST and undone + undid < CONFUSED_TWICE:
                count += 1
                heapq.heappush(heap, (value, count, paid + price, following, undone + undid))
        if best is not text and plausible(best):
            break
    return best, baseline - best_cost


#: How much less a passage, or each foreign character of a sentence, must cost for a reading to count as undone;
#: of a sentence in Latin letters more, as accented letters and quotation marks cost about the same.
PASSAGE_GAIN, CHARACTER_GAIN, LATIN_GAIN = 2.0, 0.15, 1.0
#: The same for one word of foreign characters, and what it has to become; two characters look better by chance.
FEW_GAIN = 3.0
RUN = re.compile("[^\x00-\x7f]{3,}")
RIGHT_RUN = re.compile("[А-яЁё][а-яё]+|[А-ЯЁ]+|[^\\w]+")
FEW_LETTERS = re.compile("[А-яЁё][а-яё]{2,}|[\u3040-\u30ff\u3400-\u9fff々、。]*[\u3040-\u30ff][\u3040-\u30ff\u3400-\u9fff々、。]*|[\u3400-\u9fff]{2,}")
HAN_OR_HALF = re.compile("[\u3400-\u9fff\uff61-\uff9f]")
#: Trees, tables and bars of one kind of lines; Russian letters read as such use all kinds.
DRAWN = re.compile("[\x00-\x7f\xa0─│┌┐└┘├┤┬┴┼╭╮╯╰]*|[\x00-\x7f\xa0═║╔╗╚╝╠╣╦╩╬]*|[\x00-\x7f\xa0\u2580-\u25ff]*")
LINES = re.compile(r"[^\n]+")
ODD = re.compile("[^\x00-\x7f]{2}|[^\x00-\x7f]&|&#|;&")
#: A garbled letter whose continuation became a blank, and signs that a right word of Latin letters doesn't have.
BEFORE_BLANK = re.compile(r"(?:(?<![A-ZÀ-Þ])([ÃÂ])(?=\s|$)|(?<=[a-zß-ÿ])([ÃÂ])(?![^\W\d_]))( (?=\s))?")
ODD_INSIDE = "[¡-§«¬¯°´¶¸»-¿‚ƒ„†‡ˆ˜‰‹›€Θ√∂∑∏∫Ω≈∆◊]"
LETTER = "[a-zß-öø-ÿ]"
ODD_LEFT = re.compile(f"{LETTER}{{2}}[À-ÖØ-ÞŠŽ](?![^\\W\\d_])|{LETTER}(?:{ODD_INSIDE}{LETTER}|[‚ƒˆ˜])")
ODD_SIGN = re.compile(rf"{LETTER}[À-ÖØ-ÞŠŽŸŒ]|{LETTER}{ODD_INSIDE}{LETTER}|{LETTER}[‚ƒˆ˜]|[a-z][\u0400-\u04ff]|[\u0400-\u04ff][a-z]")
QUOTED = re.compile("((?<![^\\s(,;:])[“\"'`‘«(\\[„][^\x00-\x7f\\s]{1,8}[”\"'`’»)\\]“](?![^\\s),.;:!?]))")
SENTENCE = re.compile(r"((?<=[.!?])\s+|(?<=。))")
FOREIGN = re.compile("[^\x00-\x7f]")
CYRILLIC = re.compile("[\u0400-\u04ff]")
NOT_LATIN = re.compile("[\u0400-\u04ff\u3040-\u30ff]{2}")
LOST_CHARACTER = re.compile("(?<![“\"'`‘«(\\[„])�|�(?![”\"'`’»)\\]])")


#: Characters beyond ASCII and references without a blank between them: what a reading changes lies within one such run.
UNIT = re.compile(r"(?:[^\x00-\x7f]|&(?:amp;)*#?\w+;?)+")
#: Runs that are remembered, and the longest of them.
KEPT, KEPT_CHARS = 100_000, 80


def _beside(text: str, at: int) -> str:
    """What stands for a run's neighbour: of ASCII only letters and their case have a cost beside others."""
    char = text[at : at + 1] if at >= 0 else ""
    return "a" if "a" <= char <= "z" else "A" if "A" <= char <= "Z" else " "


class Restorer:
    """Texts to (affected, restored text); what was found for short runs is remembered."""

    def __init__(self) -> None:
        self.known: dict[str, dict] = {}

    def _readings(self, unit: str) -> dict:
        found = self.known.get(unit)
        if found is None:
            found = readings(unit)
            if len(unit) <= KEPT_CHARS:
                if len(self.known) >= KEPT:
                    self.known.clear()
                self.known[unit] = found
        return found

    def _utf8(self, passage: str) -> str:
        """The passage with readings of UTF-8 undone: the path that gains most over all runs, then the next for what is left."""
        now, gained = passage, 0.0
        while True:
            at = [(m.start(), m.end(), self._readings(_beside(now, m.start() - 1) + m.group() + _beside(now, m.end()))) for m in UNIT.finditer(now)]
            totals: dict[tuple[str, ...], float] = {}
            prices: dict[tuple[str, ...], float] = {}
            for _, _, found in at:
                for path, (gain, price, _) in found.items():
                    totals[path] = totals.get(path, 0.0) + gain
                    prices[path] = max(prices.get(path, 0.0), price)
            if not totals:
                break
            path = max(totals, key=lambda p: totals[p] - prices[p])
            gained += totals[path] - prices[path]
            out, end = [], 0
            for a, b, found in at:
                if path in found:
                    out += [now[end:a], found[path][2][1:-1]]
                    end = b
            now = "".join([*out, now[end:]])
            if path[0] == UNESCAPED:  # the garbled text was escaped, so right references in it were as well
                now = html.unescape(now)
        return now if gained >= PASSAGE_GAIN else passage

    def _sentence(self, sentence: str) -> str:
        """A sentence in which one encoding was read as another that isn't UTF-8."""
        if DRAWN.fullmatch(sentence):
            return sentence
        foreign = len(FOREIGN.findall(sentence))
        if foreign >= 6 and (cost(sentence) >= (0.7 if CYRILLIC.search(sentence) else 1.5) * foreign or HAN_OR_HALF.search(sentence)):
            better, gain = search(sentence)
            if gain >= (CHARACTER_GAIN if NOT_LATIN.search(better) else LATIN_GAIN) * foreign:
                return better
        return RUN.sub(self._run, sentence) if RUN.search(sentence) else sentence

    def _run(self, m: re.Match) -> str:
        """One word of a script other than Latin; it has to become letters only, and no capitals inside."""
        word = m.group()
        if RIGHT_RUN.fullmatch(word) or cost(word) < FEW_GAIN:
            return word
        read = [w for w, undid, _ in _confused_steps(word) if undid and FEW_LETTERS.fullmatch(w)]
        best = min(read, key=cost, default=word)
        return best if cost(word) - cost(best) - STEP >= FEW_GAIN else word

    def _word(self, m: re.Match) -> str:
        """A word with an odd sign, read wrongly alone; its foreign characters have to become letters."""
        word = m.group()
        if word.isascii() or not ODD_SIGN.search(word):
            return word
        read = [w for w, undid, _ in _confused_steps(word) if undid and all(map(str.isalpha, FOREIGN.findall(w))) and plausible(w)]
        best = min(read, key=cost, default=word)
        return best if cost(word) - cost(best) - STEP >= PASSAGE_GAIN else word

    def _alone(self, passage: str) -> str:
        """What single characters show: a letter before a lost no-break space, and odd signs in words."""
        passage = BEFORE_BLANK.sub(lambda m: "à" if "Ã" in m.group() else " " if m.group(3) else "", passage)
        return re.sub(r"\S+", self._word, passage) if ODD_SIGN.search(passage) else passage

    def _passage(self, passage: str) -> str:
        return self._alone(self._searched(passage))

    def _searched(self, passage: str) -> str:
        if not ODD.search(passage):
            return passage
        found = self._utf8(passage)
        if found != passage and plausible(found):
            return found
        parts = [self._sentence(part) for part in SENTENCE.split(passage)]
        other = "".join(parts)
        if found == passage == other:
            return passage
        mixed = "".join(self._sentence(part) for part in SENTENCE.split(found)) if found != passage else other
        others = (other, self._sentence(passage))
        if found == passage:
            return min(others, key=cost)
        best = min((found, mixed), key=cost)  # sequences of UTF-8 are hardly there by chance
        return min((best, *others), key=lambda text: cost(text) + (0.0 if text is best else SECOND_STEP))

    def _line(self, line: str) -> str:
        if line.isascii() and "&" not in line:
            return line
        # Quoted garbled characters are examples; what stands between them is looked at.
        return "".join(part if k % 2 else self._passage(part) for k, part in enumerate(QUOTED.split(line)))

    def __call__(self, text: str | None) -> tuple[bool, str | None]:
        if not text or (text.isascii() and "&" not in text):
            return False, text
        restored = LINES.sub(lambda m: self._line(m.group()), text)
        affected = restored != text or bool(LOST_CHARACTER.search(text)) or bool(STRAY_CONTROL.search(text))
        affected = affected or any(ODD_LEFT.search(part) for part in QUOTED.split(restored)[::2])
        return affected, restored


def restore(texts: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id_col, restored, whole) of every affected row; ``whole`` is false where characters stay lost."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer()
        for batch in batches:
            kept, out, whole = [], [], []
            for k, text in enumerate(batch.column(1).to_pylist()):
                affected, restored = restorer(text)
                if affected:
                    kept.append(k)
                    out.append(restored)
                    whole.append("�" not in restored and not STRAY_CONTROL.search(restored))
            if kept:
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(kept)), pa.array(out, pa.string()), pa.array(whole)], names=[id_col, "restored", "whole"])

    rows = texts.select(F.col(id_col), F.col(text_col).cast("string")).where(F.col(text_col).rlike(r"[^\x00-\x7f]|&"))
    return spread(rows).mapInArrow(run, f"`{id_col}` {rows.schema[0].dataType.simpleString()}, restored string, whole boolean")
