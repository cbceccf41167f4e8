"""Sentence units of texts in any language and layout.

A text is cut into blocks at empty lines, list items with their marks and the line
that opens a list become units, and what is left is split along the best path through a lattice.

Lattice of terminators. Every run of terminators with its closing marks, and every gap beside
a script without spaces, is a node that may end a sentence; an edge is the sentence between two nodes. A
node has a score for being an end: what the words on either side say for certain (titles, company
forms, initials, ordinals, speech tags, a small letter that goes on) outweighs all else, what they make likely
(shape of the word, how it is written elsewhere in the text, what follows) does not. An edge costs for a sentence
without a word or of a single one and for a bracket left open, so that neighbouring nodes decide
together. The path of the highest sum is exact and linear in the text.

Scripts without spaces are segmented into words over a lattice of dictionary words (the cheapest path), and a gap
between phrases is classified by the last word before and the first word after it: final
particles and opening words end, linking words run on, short pieces are enumerations. The dictionary of Thai
is that of the Java platform, whose word breaks of the text come with it; together with the listed words,
which are the dictionary of Lao, Khmer, Burmese, Chinese and Japanese. The last four have terminators of their own: their gaps
count only in a block that has none.

Offsets count code points. Units carry no white space at their ends and cover all other
characters. Null, empty and blank texts give no rows. No model and no state: the same
text always gives the same units. No look ahead or back has a length of its own, and a text is never cut short.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Words of the languages that decide at a full stop.
#: Never the end of a sentence: titles, references and what else always has a word after it.
LEADING = set(
    "mr mrs ms messrs dr dra prof gov sen rep gen col lt capt st hr fr sr sra sres mme mlle mm "
    "cf p pp pág págs vs approx est incl excl no nos nr art arts sec fig figs vol ch eq abbr ca vgl evtl ggf inkl exkl bzw sog mio mrd "
    "ex ej av env núm см стр тыс им ул рис проф акад gr viz resp min डॉ श्री د أ ee".split()
)
#: End only before a word that opens a sentence; what they stand before otherwise is a name.
NAMED = {"jr"}
#: Company forms: they end a sentence before a capital letter unless another form follows.
FORMS = set("co inc ltd corp plc bros kg kgaa ag sa llc gmbh lp".split())
#: Close an enumeration: they end a sentence before anything but a small letter.
AND_SO_ON = set("etc usw osv itd itp enz atd jne ecc".split())
#: Words that go on after a time of day or a country.
AFTER_TIME = set("Eastern Central Pacific Mountain Atlantic EST EDT ET CET CEST BST GMT UTC JST London Tokyo New".split())
AFTER_COUNTRY = set(
    "Treasury Federal Fed Senate Congress Department Government Army Navy House President Supreme District Securities Commerce Labor Justice Food Attorney Court Census Postal Energy Steel Geological Dollar Bank Representative Secretary".split()
)
#: Words that open sentences.
OPENERS = set(
    "The A An In On At By For From With It Its He She We They This That These Those There But And So However Still Earlier Later Elsewhere Meanwhile Separately Further Also "
    "After Before When While If As Our Their His Her No Nobody What Who Why How Is Are Was Der Die Das Ein Eine Im Am Laut Was Le La Les Un Une El Los Las Il Elle".split()
)
#: What a German ordinal number counts.
ORDINALS = set(
    "Januar Jänner Februar März April Mai Juni Juli August September Oktober November Dezember Quartal Halbjahr Jahr Jahrhundert Jahrestag Monat Woche Tag Mal Platz Rang Auflage Geschäftsjahr Kapitel Mai".split()
)
MONTHS = set("jan feb mar apr jun jul aug sep sept oct okt nov dec dez".split())
#: Japanese particles that run on after a closing bracket, and Chinese verbs of a speech tag.
RUN_ON = ("と", "って", "という", "など", "を", "が", "は", "も", "に", "の", "で", "へ", "や", "、", "，")
SPEECH = regex.compile(r"[，,]?[^，,。！？；\n「」“”（）]*?(?:表示|指出|说道|说|称|问道|问|回答|写道)[。！？：]")

#: Thai words: openers start a clause, particles close one, links need what comes next or before.
THAI_OPENERS = set("นักลงทุน ตลาด โรงงาน กองทุน คณะกรรมการ หุ้น รายได้ ค่าใช้จ่าย บริษัท กำไร ราคา แต่ ดังนั้น อย่างไรก็ตาม นอกจากนี้ ขณะที่ ทั้งนี้ เมื่อ หาก เรา เขา ผู้บริหาร ธนาคาร รัฐบาล ยอดขาย การ ความ".split())
THAI_PARTICLES = set("ครับ ค่ะ คะ นะ แล้ว จ้ะ เลย ด้วย".split())
THAI_LINKS = set("และ หรือ กับ ของ ที่ ใน เพื่อ โดย ว่า คือ เช่น ซึ่ง จาก ต่อ ถึง ตาม เป็น อยู่ที่ ได้แก่ ประมาณ ราว ถือ ปรับขึ้น ปรับลง ลดลง เพิ่มขึ้น".split())
#: By script: words that open a clause, close one, or link what stands beside them. Common function words of each language.
FUNCTION_WORDS = {
    "Thai": (THAI_OPENERS, THAI_PARTICLES, THAI_LINKS),
    "Lao": (set("ແຕ່ ດັ່ງນັ້ນ ເມື່ອ ຖ້າ ນອກຈາກ ລາວ ພວກເຮົາ ຂ້ອຍ ຂ້າພະເຈົ້າ ບໍລິສັດ ລັດຖະບານ ຕະຫຼາດ ການ ຄວາມ".split()), set("ແລ້ວ ເດີ ເດີ້ ແດ່ ບໍ ນໍ ເນາະ".split()), set("ແລະ ຫຼື ກັບ ຂອງ ທີ່ ໃນ ເພື່ອ ໂດຍ ວ່າ ຄື ຈາກ ຕໍ່ ເຖິງ ຕາມ ເປັນ ເຊິ່ງ".split())),
    "Khmer": (set("ប៉ុន្តែ ដូច្នេះ នៅពេល ប្រសិនបើ លើសពីនេះ គាត់ យើង ខ្ញុំ ក្រុមហ៊ុន រដ្ឋាភិបាល".split()), set("ទេ ហើយ ណា ណ៎ ចុះ".split()), set("និង ឬ ជាមួយ របស់ ដែល ក្នុង ដើម្បី ដោយ ថា គឺ ពី ដល់ តាម ជា".split())),
    "Myanmar": (set("ဒါပေမဲ့ သို့သော် ထို့ကြောင့် ဒါကြောင့် အကယ်၍ သူ ကျွန်တော် ကျွန်မ ကုမ္ပဏီ အစိုးရ".split()), set("တယ် မယ် ပါ ဘူး လား သည် ပြီ တော့ နော်".split()), set("နှင့် နဲ့ သို့မဟုတ် ၏ သော တွင် မှာ ရန် ဖြင့် ဟု ကို က".split())),
    "CJK": (
        set("しかし また でも そして だから なお さらに 一方 ただし それで そこで まず 次に 但是 不过 所以 因此 然后 此外 另外 同时 随后 我们 他们 今天 昨天 目前".split()),
        set("です ます ました ません でした でしょう だろう だった である ください ね よ か 了 吗 呢 吧 啊 嘛 呀".split()),
        set("と が を に は も の で へ や から まで という など って より けど ので 的 和 与 或 在 是 把 被 对 从 向 及".split()),
    ),
}
LISTED = {script: frozenset().union(*kinds) for script, kinds in FUNCTION_WORDS.items()}

_SPACE = r"\s"
_CLOSERS = "\"'”’»›)\\]}」』）】》〉"
_OPENERS = regex.compile(r"[\"'“‘„‚«‹(\[{¿¡「『（【《〈\s]*")
_BLOCK = regex.compile(r"\n[^\S\n]*\n\s*")
_BULLET = regex.compile(r"[^\S\n]*[•*‣▪●◦·–-][^\S\n]+\S")
_NUMBER = regex.compile(r"[^\S\n]*(?:\d{1,3}[.)]|\([0-9a-z]{1,3}\))[^\S\n]+\S")
_EMOJI = r"[\U0001F300-\U0001FAFF☀-➿️‍]"
_MARKS = rf"(?:[.!?…]+[{_CLOSERS}]*)+(?:[\s ]+»)?|[؟।॥۔።។၊။]+[{_CLOSERS}]*|[。！？｡．]+(?:…+)?[{_CLOSERS}。！？]*|(?<=[」』])(?=\S)|{_EMOJI}+(?=\s)"
_END = regex.compile(_MARKS)
#: Scripts without spaces, and the terminators of those that have their own.
_SPACELESS = {script: rf"\p{{{script}}}" for script in ("Thai", "Lao", "Khmer", "Myanmar")} | {"CJK": r"[\p{Han}\p{Hiragana}\p{Katakana}]"}
_ANY_SPACELESS = regex.compile("|".join(_SPACELESS.values()))
_OWN_MARKS = {"Khmer": "។៕", "Myanmar": "။", "CJK": "。！？｡．!?…"}
#: Every gap beside such a script is a node too.
_END_GAPS = {script: regex.compile(rf"{_MARKS}|(?<={c})\s+(?=\S)|(?<=\S)\s+(?={c})") for script, c in _SPACELESS.items()}
#: A sentence that follows without a space; addresses and file names have a slash, a sign or no capital there.
_GLUED_AFTER = regex.compile(r"\p{Lu}[\p{Ll}\p{M}]+[.,]?(?:\s|$)|\p{Lu}\s|\p{Lu}{2,}\s")
#: White space as ``str.isspace`` has it, and what stands between two gaps.
_BLANKS, _STRETCH = re.compile(r"\s*"), regex.compile(r"\S*")
_CJK = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}]")
_NEXT = regex.compile(r"[\p{L}\p{M}\p{N}&.’'-]+")


#: Scores beyond this are certain: no edge can outweigh them.
CERTAIN = 8.0
#: What an edge costs: a sentence without a word, of one word, with a bracket left open. Together less than CERTAIN / 2.
NO_WORD, ONE_WORD, OPEN_BRACKET = 1.0, 0.5, 2.0
_WORDS = regex.compile(r"\w+")
#: Letter pairs in which Latin words of few letters end when they end in two consonants; fixed values.
_FINALS = set("nt st rd ld nd ng nk rk rt lt ft ct ss ll ck th sh ch ts rs ns ls ks ps ms ds ws gs bs wn rm rn lm mp pt lk lp sk xt ff tz gh zz rb rl rf lf rg rz tt nn mm rr pp dd gg gn".split())
_LATIN = re.compile(r"[A-Za-zÀ-ÿ]+")
_VOWELS = set("aeiouyAEIOUYàáâäãåæèéêëìíîïòóôöõøœùúûüýÿÀÁÂÄÃÅÆÈÉÊËÌÍÎÏÒÓÔÖÕØŒÙÚÛÜÝ")
#: German words before an ordinal.
BEFORE_ORDINAL = set("der die das den dem des im am zum zur vom beim ein eine einen einem seit bis ab auf".split())


def word_lattice(text: str, words: frozenset[str] | set[str], longest: int) -> list[str]:
    """The cheapest path through the lattice of dictionary words over ``text``.

    A dictionary word costs 1, a stretch outside the dictionary 2 and a little more per character, so known
    words win wherever they fit. The path is exact (no beam) and linear in the text.
    """
    n = len(text)
    best = [0.0] + [math.inf] * n
    back = [0] * (n + 1)
    known = [False] * (n + 1)
    for i in range(n):
        for j in range(i + 1, min(n, i + longest) + 1):
            if text[i:j] in words and best[i] + 1 < best[j]:
                best[j], back[j], known[j] = best[i] + 1, i, True
        # one more character of an unknown stretch
        cost = best[i] + (0.6 if i and not known[i] else 2.6)
        if cost < best[i + 1]:
            best[i + 1], back[i + 1], known[i + 1] = cost, i, False
    found, at, end = [], n, n
    while at > 0:
        start = back[at]
        if known[at]:
            found.append(text[start:at])
            end = start
        elif start == 0 or known[start]:
            found.append(text[start:end])
            end = start
        at = start
    return found[::-1]


class _Gaps:
    """Classifies gaps beside one script without spaces; ``lexicon`` are dictionary words beside the listed ones."""

    def __init__(self, script: str, lexicon: frozenset[str]):
        self.letter = regex.compile(_SPACELESS[script])
        self.openers, self.particles, self.links = FUNCTION_WORDS[script]
        self.words = LISTED[script] | lexicon
        self.longest = max(map(len, self.words))
        # a stretch is the right side of one gap and the left of the next
        self.segmented = lru_cache(maxsize=4)(lambda text: word_lattice(text, self.words, self.longest))

    def score(self, left: str, right: str) -> float:
        """Score of a gap for being an end; ``left`` and ``right`` are the stretches beside it."""
        a, b = bool(self.letter.match(left[-1:])), bool(self.letter.match(right[:1]))
        before, after = self.segmented(left) if a else [], self.segmented(right) if b else []
        last, first = before[-1] if a else "", after[0] if b else ""
        if last in self.particles:
            return CERTAIN if self.links.isdisjoint([first]) else -CERTAIN
        if last in self.links or first in self.links or right[:1] in "ๆฯ":
            return -CERTAIN
        if a and b:
            # short pieces are an enumeration, unless one opens a clause
            short = (len(before) <= 2) + (len(after) <= 2)
            return 2.0 + 3.0 * (first in self.openers) - 1.5 * short
        # beside a number or a foreign name the phrase goes on, unless a new clause is opened
        return CERTAIN if b and not a and first in self.openers and left[-1:] not in "0123456789" else -CERTAIN


def _word_start(text: str, start: int, at: int) -> int:
    """Where the word before ``at`` starts, single letters with full stops before it included (U.S., z.B.)."""
    i = at
    while i > start and (text[i - 1].isalnum() or text[i - 1] in "&/’'-" or regex.match(r"\p{M}", text[i - 1])):
        i -= 1
    while i - 2 >= start and text[i - 1] == "." and text[i - 2].isalpha():
        i -= 2
    return i


def _likely(text: str, word: str, begin: int, first: str, nxt: str) -> float:
    """Score of a full stop after a word that no list knows: from its shape, from how the text writes it elsewhere, and from what follows."""
    score = 2.0
    if not word.isupper() and len(word) <= 4 and _LATIN.fullmatch(word):
        consonants = not _VOWELS.intersection(word)
        odd = len(word) > 1 and not _VOWELS.intersection(word[-2:]) and word[-2:].lower() not in _FINALS
        if consonants:
            score -= 4.0
        elif odd:
            score -= 3.0
        elif len(word) <= 3 and first.isdigit():
            score -= 1.0
    if score < 2.0:
        # elsewhere without a full stop it is a word like others, before a small letter with one it is an abbreviation
        bare = regex.escape(word)
        if regex.search(rf"(?<![\w.]){bare}(?=[\s,;:!?])", text):
            score += 3.0
        if regex.search(rf"(?<![\w.]){bare}\.\s+\p{{Ll}}", text):
            score -= 2.0
        if nxt in OPENERS:
            score += 3.0
        # a unit after its number
        if begin > 1 and text[begin - 1].isspace() and text[begin - 2].isdigit():
            score += 3.0
    return score


def _full_stop(text: str, start: int, at: int, closers: bool, first: str, nxt: str) -> float:
    """Score of a single full stop at ``at`` for ending the sentence; ``first`` is the first character that follows, ``nxt`` its word."""
    sure = lambda ends: CERTAIN if ends else -CERTAIN
    if first.islower():
        return -CERTAIN
    if closers:
        return CERTAIN
    begin = _word_start(text, start, at)
    word = text[begin:at]
    low, upper = word.lower(), nxt.rstrip(".")
    if not word:
        return CERTAIN
    if word.isdigit():
        if len(word) <= 2 and upper in ORDINALS:
            return -CERTAIN
        if len(word) <= 2 and first.isupper() and nxt not in OPENERS and (m := regex.search(r"(?r)(\p{L}+)\s+", text, pos=start, endpos=begin)) and m.end() == begin and m.group(1).lower() in BEFORE_ORDINAL:
            return -1.0
        return CERTAIN
    if "." in word:  # U.S., a.m., N.V., i.e.
        if low in ("a.m", "p.m"):
            return sure(upper not in AFTER_TIME)
        if low in ("i.e", "e.g"):
            return -CERTAIN
        if low in ("u.s", "u.k", "u.n", "e.u"):
            return sure(upper not in AFTER_COUNTRY and not first.isdigit())
        return sure(upper.lower() not in FORMS)
    if low in LEADING:
        return -CERTAIN
    if low in AND_SO_ON:
        return CERTAIN
    if low in FORMS:
        return sure(upper.lower() not in FORMS)
    if low in MONTHS:
        return sure(not first.isdigit())
    if low in ("г", "д", "п"):
        k = begin
        while k > start and text[k - 1].isspace():
            k -= 1
        if low == "г":
            return sure(k > start and text[k - 1].isdigit())
        if text.startswith("т.", k - 2) and k - 2 >= start:
            return CERTAIN
    if low == "uu":
        return CERTAIN
    if low in NAMED:
        return sure(nxt in OPENERS)
    letters = regex.sub(r"\p{M}", "", word)
    if len(letters) == 1 and letters.isalpha() and not _CJK.match(letters):
        return sure(nxt in OPENERS)
    return _likely(text, word, begin, first, nxt)


def _glued(text: str, start: int, at: int, then: int) -> bool:
    """Whether a sentence follows without a space: an ordinary word before, a capitalised one after it."""
    i = at
    while i > start and (text[i - 1].isalpha() or text[i - 1] in "’'-" or regex.match(r"\p{M}", text[i - 1])):
        i -= 1
    word = text[i:at]
    if not word or not word[0].isalpha() or (i > start and (text[i - 1] in "/@\\._" or text[i - 1].isalnum())):
        return False
    return bool(regex.search(r"\p{Ll}\p{M}*$", word)) and word.lower() not in LEADING and bool(_GLUED_AFTER.match(text, then))


def _best_path(text: str, nodes: list[tuple[int, int, int, float]]) -> list[int]:
    """The nodes at which sentences end along the path of the highest sum.

    A state is what an edge may still cost: words since the last end (none, one, more) and brackets open.
    """
    if all(abs(x[3]) >= CERTAIN / 2 for x in nodes):
        return [k for k, x in enumerate(nodes) if x[3] > 0]
    states: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
    at = 0
    for k, (_, end, then, score) in enumerate(nodes):
        piece = text[at:end]
        words, opened = len(_WORDS.findall(piece)), piece.count("(") - piece.count(")")
        fresh: dict[tuple[int, int], tuple[float, tuple | None]] = {}
        ended = (-math.inf, None)
        for (w, depth), (total, path) in states.items():
            w, depth = min(2, w + words), max(0, depth + opened)
            here = total + score - (NO_WORD if w == 0 else ONE_WORD if w == 1 else 0.0) - (OPEN_BRACKET if depth else 0.0)
            if here > ended[0]:
                ended = (here, (k, path))
            if total > fresh.get((w, depth), (-math.inf, None))[0]:
                fresh[(w, depth)] = (total, path)
        if ended[0] > fresh.get((0, 0), (-math.inf, None))[0]:
            fresh[(0, 0)] = ended
        states, at = fresh, then
    path = max(states.values(), key=lambda x: x[0])[1]
    ends = []
    while path is not None:
        ends.append(path[0])
        path = path[1]
    return ends[::-1]


def _script(text: str) -> str | None:
    """The first script without spaces in a stretch, whose gaps count: it has no terminators, or none here."""
    m = _ANY_SPACELESS.search(text)
    if not m:
        return None
    script = next(s for s, c in _SPACELESS.items() if regex.match(c, m.group()))
    return None if any(c in text for c in _OWN_MARKS.get(script, "")) else script


def split_text(text: str, lexicon: frozenset[str] = frozenset()) -> list[tuple[int, int]]:
    """Spans of the sentences in a stretch of running text; ``lexicon`` are words of its scripts without spaces."""
    n, script = len(text), _script(text)
    gaps = _Gaps(script, lexicon) if script else None
    nodes, start = [], 0
    for m in (_END_GAPS[script] if script else _END).finditer(text):
        at, end = m.span()
        if end <= start or end >= n:
            continue
        mark = m.group()
        if text[end] == "“" and "„" in text[start:at]:
            # closes the low quotation mark; elsewhere it opens
            end, mark = end + 1, mark + "”"
            if end == n:
                continue
        # where the text goes on, however far that is
        then = _BLANKS.match(text, end).end()
        if then == n:
            continue
        gap, follows = then - end, text[then]
        opened = _OPENERS.match(text, then).end()
        body = text[opened : opened + 1]
        closers = mark.rstrip()[-1:] in _CLOSERS and bool(mark.strip())
        kind = mark.strip()[:1]
        score: float | None = None
        if not mark:  # after a closing bracket without terminator
            ends = text[start:at].lstrip()[:1] in "「『" and not text.startswith(RUN_ON, then) and "」" not in text[start : at - 1]
        elif mark.isspace():
            # the stretch on either side up to the next gap
            token = at
            while token > start and not text[token - 1].isspace():
                token -= 1
            score = gaps.score(text[token:at], _STRETCH.match(text, end).group())
        elif kind in "。！？｡．":
            ends = not text.startswith(RUN_ON, then) and not (mark[-1] in "”」』" and SPEECH.match(text, then)) if closers else follows not in "」』”）"
        elif kind in "؟।॥۔።។၊။":
            ends = gap > 0 or kind != "؟"
        elif regex.match(_EMOJI, kind):
            ends = True
        elif gap == 0:
            # no space: only between characters of spaceless scripts
            beside = _CJK.match(text[at - 1 : at] or "") and (_CJK.match(follows) or follows in "「『（“" or (kind == "…" and follows.isalpha()))
            ends = bool(beside) and (kind in "!?" or "…" in mark) and not text.startswith(RUN_ON, then) or _glued(text, start, at, then)
        elif "!" in mark or "?" in mark:
            ends = not (closers and body.islower())
        elif "…" in mark or ".." in mark:
            ends = not body.islower()
        elif body:
            following = _NEXT.match(text, opened)
            score = _full_stop(text, start, at, closers, body, following.group() if following else "")
        else:
            ends = False
        if score is None:
            score = CERTAIN if ends else -CERTAIN
        nodes.append((at, end, then, score))
        if score >= CERTAIN:  # every path ends here
            start = then
    spans, start = [], 0
    for k in _best_path(text, nodes):
        spans.append((start, nodes[k][1]))
        start = nodes[k][2]
    spans.append((start, n))
    return spans


def _units(text: str, lexicon: frozenset[str]) -> Iterator[tuple[int, int]]:
    """Spans of the blocks' lists and running text, split into sentences."""
    bounds = [0, *(x for m in _BLOCK.finditer(text) for x in m.span()), len(text)]
    for begin, end in zip(bounds[::2], bounds[1::2]):
        lines, at = [], begin
        for line in text[begin:end].split("\n"):
            lines.append((at, at + len(line), line))
            at += len(line) + 1
        item: list[bool] = []
        for k, (_, _, line) in enumerate(lines):
            numbered = bool(_NUMBER.match(line)) and (k == 0 or (item[k - 1] and bool(_NUMBER.match(lines[k - 1][2]))) or lines[k - 1][2].rstrip().endswith(":"))
            item.append(bool(_BULLET.match(line)) or numbered)
        run = None
        for k, (a, b, _) in enumerate(lines):
            alone = item[k] or (k + 1 < len(lines) and item[k + 1])
            if alone or run is None:
                if run is not None:
                    yield from ((run[0] + x, run[0] + y) for x, y in split_text(text[run[0] : run[1]], lexicon))
                    run = None
                if alone:
                    yield a, b
                else:
                    run = (a, b)
            else:
                run = (run[0], b)
        if run is not None:
            yield from ((run[0] + x, run[0] + y) for x, y in split_text(text[run[0] : run[1]], lexicon))


def sentence_spans(text: str | None, lexicon: frozenset[str] = frozenset()) -> list[tuple[int, int]]:
    """(start, end) of every sentence, trimmed; none for null and blank texts."""
    out, text = [], text or ""
    for a, b in _units(text, lexicon):
        piece = text[a:b]
        a += len(piece) - len(piece.lstrip())
        b = a + len(piece.strip())
        if a < b:
            out.append((a, b))
    return out


def _split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, starts, ends = [], [], []
        for i, text, lexicon in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist(), batch.column("lexicon").to_pylist()):
            for a, b in sentence_spans(text, frozenset(lexicon or ())):
                ids.append(i)
                starts.append(a)
                ends.append(b)
        yield pa.record_batch({"id": pa.array(ids, pa.int64()), "sent_start": pa.array(starts, pa.int64()), "sent_end": pa.array(ends, pa.int64())})


def thai_lexicon(text: Column) -> Column:
    """The Thai words of a text by the dictionary of the Java platform; null where it has no Thai.

    A Java platform without that dictionary gives whole stretches, and the listed words remain.
    """
    return F.when(text.rlike("[\u0e00-\u0e7f]"), F.array_distinct(F.flatten(F.sentences(text, F.lit("th"), F.lit("TH")))))


def sentences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per sentence: the document's id, ``sent_start``, ``sent_end`` (exclusive)."""
    from quaymark.llm.encoding import spread

    rows = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{text_col}`").alias("text")).filter("text IS NOT NULL")
    worded = spread(rows, "id").withColumn("lexicon", thai_lexicon(F.col("text")))
    return worded.mapInArrow(_split, "id long, sent_start long, sent_end long").withColumnRenamed("id", id_col)
