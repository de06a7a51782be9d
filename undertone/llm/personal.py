"""Problem 10: personal information inside free text.

Detection is a list of matchers per kind, applied in the order e-mail, identity
number, telephone number, street address, person name; what one kind has taken
is closed for the next, so a name inside an address does not count again.
Every mention then gets a keyed replacement of its own kind and format. It is
written piece by piece: numbers are enciphered by a keyed permutation of the
numbers of their length, words become keyed words of the same script, case and
gender mark, and signs, titles, connectors, kinds of street, country codes and
endings of domains stay. A piece becomes the same in every text and format, so
mentions of one entity agree however they are written; an entity whose
replacement another entity of the text has, or is, is drawn again.
"""

from __future__ import annotations

import hashlib
import hmac
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from undertone.llm.arrow import fits, schema_with
from undertone.llm.lookalike import INVISIBLE, LOOKALIKES
from undertone.sources.tables import table

KINDS = ("email", "id_number", "phone", "street_address", "person_name")
MAX_NAMES = 500_000

# One character for one, so places in the text stay: full width, blanks of
# other widths, letters of other scripts that draw like Latin ones.
_WIDE = re.compile("[！-～\u00a0\u1680\u2000-\u200a\u202f\u205f\u3000\u0391-\u03ff\u0400-\u04ff]")
_NARROW = {0xFF01 + k: 0x21 + k for k in range(94)} | dict.fromkeys([0xA0, 0x1680, *range(0x2000, 0x200B), 0x202F, 0x205F, 0x3000], 0x20)
_HIDDEN = re.compile(f"[{INVISIBLE}\u200d]")
_NARROW |= {ord(a): ord(b) for source, target in LOOKALIKES.items() for a, b in zip(source, target)}

# Number words, titles, connectors, kinds of street, words that
# announce a name.
DIGIT_WORDS = {"zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9"}
TITLES_M = ("Mr", "Encik", "Tuan")
TITLES_F = ("Ms", "Mrs", "Mdm", "Madam", "Miss", "Puan", "Cik")
TITLES_N = ("Dr", "Prof")
LINKS = ("bin", "binti", "s/o", "d/o", "a/l", "a/p")
STREETS = ("Road", "Street", "Lane", "Avenue", "Walk", "Close", "Crescent", "Rise", "Drive", "Way", "Place", "Terrace", "Link", "Grove", "Boulevard", "Court", "Park", "View", "Gardens", "Hill", "Square")
NO_STREET = ("of", "the", "a", "an", "to", "in", "on", "at", "and", "or", "for", "with", "from", "by", "clips", "rows", "sets", "samples", "steps")
STREETS_FIRST = ("Jalan", "Lorong", "Jl.?", "Jln", "Persiaran", "Lebuh", "Gang")
ANNOUNCE = (
    r"my name is",
    r"my name's",
    r"i am called",
    r"i'm called",
    r"call me",
    r"(?:full )?name ?:",
    r"nama(?: (?:saya|aku|penuh|lengkap|beliau|dia))?(?: (?:ialah|adalah))? ?:?",
    r"signed by",
    r"annotated with",
    r"waited for",
    r"waiting for",
    r"ditandatangani oleh",
    r"diisi oleh",
    r"(?:kami )?menunggu",
    r"this is(?= [\w/' ,-]{3,50} speaking)",
    r"姓名[：:]",
    r"我叫",
    r"我们在等",
    r"表格由",
    r"later(?= [\w/' ,-]{3,50} took the microphone)",
)
HAN_ANNOUNCE = r"我叫|我是|姓名[：:]|名字是|我们在等|在等|表格由|由(?=[一-鿿]{2,4}(?:先生|女士|小姐)?签)"
HAN_FAMILY = "赵钱孙李周吴郑王冯陈褚卫蒋沈韩杨朱秦尤许何吕施张孔曹严华金魏陶姜戚谢邹喻柏水窦章云苏潘葛奚范彭郎鲁韦昌马苗凤花方俞任袁柳鲍史唐费廉岑薛雷贺倪汤滕殷罗毕郝邬安常乐于时傅皮卞齐康伍余元卜顾孟平黄和穆萧尹姚邵湛汪祁毛禹狄米贝明臧计伏成戴谈宋茅庞熊纪舒屈项祝董梁杜阮蓝闵席季麻强贾路娄危江童颜郭梅盛林刁钟徐邱骆高夏蔡田樊胡凌霍虞万支柯管卢莫经房裘缪干解应宗丁宣邓欧阳"

_HAN = re.compile("[一-鿿]")
_AT = re.compile(r"@|[(\[]\s?at\s?[)\]]|(?<=\w) at (?=[\w-]+ dot )", re.I)
_LOCAL = re.compile(r"(?:[A-Za-z0-9](?:[\w.+-]*\w)?)(?: (?:plus|underscore|dot|dash) [A-Za-z0-9](?:[\w.+-]*\w)?)*\s?$", re.I | re.A)
_DOMAIN = re.compile(r"\s?[a-z0-9](?:[a-z0-9-]*[a-z0-9])?(?:(?:\.|\s?[(\[]\s?dot\s?[)\]]\s?| dot )[a-z0-9](?:[a-z0-9-]*[a-z0-9])?)+", re.I | re.A)
_ID = re.compile(
    r"(?<![\w+#-])(?:\d{6}-\d{2}-\d{4}|\d{16}|\d{4}(?:[ -]\d{4}){3}|(?!00)\d{12}|[a-z]\d{7}[a-z]|[a-z] \d{4} \d{3} [a-z]|[a-z] ?\d{8})(?![A-Za-z0-9_-]|[.,:]\d)", re.I | re.A
)
_PHONE = re.compile(
    r"(?<![\w+#.,:/-])(?:\(\+\d{1,3}\) ?\d{1,4}(?:[ -]?\d{3,4}){1,3}|\+\d{1,3}[ -]?\d{2,4}(?:[ -]?\d{3,4}){1,3}|00\d{1,3}[ -]?\d{3,4}[ -]?\d{3,4}(?:[ -]?\d{1,4})?|\(\d{3}\) ?\d{3}[ -]\d{4}|[3-9]\d{3}[ -]?\d{4}|0\d{1,3}[ -]\d{3,4}[ -]?\d{4})(?![A-Za-z0-9_-]|[.,:/]\d)", re.A
)
_SPOKEN = re.compile(rf"(?<![A-Za-z])(?:(?:(?:double|triple) )?(?:{'|'.join(DIGIT_WORDS)})[ ,-]{{1,2}}){{6,}}(?:(?:double|triple) )?(?:{'|'.join(DIGIT_WORDS)})(?![A-Za-z])", re.I)
_STREET_LAST = rf"(?:(?!(?:{'|'.join(NO_STREET)})\s)[A-Za-z][\w']*\s){{1,3}}(?:{'|'.join(STREETS)})"
_STREET_FIRST = rf"(?:{'|'.join(STREETS_FIRST)})\s[A-Za-z][\w']*(?:\s(?:satu|dua|tiga|empat|lima|\d{{1,2}}(?![\w-])))?"
_UNIT = r"(?:,?\s(?:unit|#|no\.?)\s?#?\d{1,3}-\d{1,4}|,?\s#\d{1,3}-\d{1,4})?"
_ADDRESS = re.compile(rf"(?<![A-Za-z0-9_#.,:/-])(?:(?:block|blk|no\.?)\s)?\d{{1,4}}[a-z]?,?\s(?:{_STREET_FIRST}|{_STREET_LAST})(?![\w]){_UNIT}(?:,?\s(?:Singapore|S)\s?\(?\d{{6}}\)?|,?\s\d{{5,6}}(?!\w))?", re.I)
_HAN_ADDRESS = re.compile(r"[一-鿿]{2}(?:大道|[路街巷弄道])\d{1,5}号(?:\d{1,3}[楼栋室](?:\d{1,4}室)?)?")
_PART = r"[A-Za-z][A-Za-z']*(?:-[A-Za-z]+)*"
_LINK = "|".join(LINKS)
_TITLE = "|".join(TITLES_M + TITLES_F + TITLES_N)
_ANNOUNCED = re.compile(rf"(?<![A-Za-z0-9_])(?:{'|'.join(ANNOUNCE)})[^\S\n]?(?P<name>(?:{_TITLE})\.?[ \xa0]{_PART}|{_PART},[ \xa0]{_PART}|{_PART}[ \xa0](?:(?:{_LINK})[ \xa0])?{_PART})", re.I)
_TITLED = re.compile(rf"(?<![A-Za-z0-9_-])(?:{_TITLE})\.?[ \xa0][A-Z]{_PART}(?:[ \xa0]{_PART})?")
_PAIR = re.compile(rf"(?<![A-Za-z0-9_-])(?:(?P<a>[A-Z][a-z']+(?:-[a-z]+)?)(?:[ \xa0](?:{_LINK})[ \xa0]|[ \xa0]|(?P<comma>,[ \xa0]))(?P<b>[A-Z][a-z']+(?:-[a-z]+)?))(?![\w-])")
_HAN_NAME = re.compile(rf"(?:{HAN_ANNOUNCE})\s?(?P<name>[{HAN_FAMILY}][一-鿿]{{1,2}}?)(?=先生|女士|小姐|签|[。，！？、；,.!?;\s]|地址|电话|邮箱|$)")
# Words that can follow an announcement and are no name.
_NOT = frozenset("the a an my your our their his her its this that these those nobody somebody everyone we they she he it you i one two and or for to in on at of is was are were not no yes so but if saya aku kami kita dia mereka itu ini yang dan kakak adik jiran cikgu pakcik beliau".split())


class Finder:
    """Finds mentions; ``names`` are (name_part, kind) rows in usual case."""

    def __init__(self, names: list[tuple[str, str]]):
        self.given = {n for n, k in names if k == "given"}
        self.family = {n for n, k in names if k == "family"}

    def find(self, text: str) -> list[tuple[int, int, str]]:
        """Sorted, disjoint (start, end, kind) spans of ``text``; characters that
        draw nothing are looked through."""
        if _HIDDEN.search(text):
            seen = [i for i, c in enumerate(text) if not _HIDDEN.match(c)]
            return [(seen[a], seen[b - 1] + 1, kind) for a, b, kind in self.find("".join(text[i] for i in seen))]
        plain = text.translate(_NARROW) if _WIDE.search(text) else text
        spans: list[tuple[int, int, str]] = []
        for kind in KINDS:
            taken = [(a, b) for a, b in getattr(self, "_" + kind)(plain) if b > a]
            if taken:
                taken.sort(key=lambda s: (s[0], -s[1]))
                out, at = [], 0
                for a, b in taken:
                    if a < at:
                        continue
                    out += [plain[at:a], "\x00" * (b - a)]
                    at = b
                    spans.append((a, b, kind))
                plain = "".join([*out, plain[at:]])
        return sorted(spans)

    def _email(self, t: str):
        for m in _AT.finditer(t):
            domain = _DOMAIN.match(t, m.end())
            if not domain:
                continue
            reach = 64
            while True:  # until what stands before the sign begins inside the window
                lo = max(0, m.start() - reach)
                local = _LOCAL.search(t[lo : m.start()])
                if not lo or local and local.start() or not local and reach > 4096:
                    break
                reach *= 2
            if local and domain and (m[0] != " at " or " dot " in domain[0]):
                yield lo + local.start(), domain.end()

    def _id_number(self, t: str):
        return [m.span() for m in _ID.finditer(t)]

    def _phone(self, t: str):
        return [m.span() for m in _PHONE.finditer(t)] + [m.span() for m in _SPOKEN.finditer(t)]

    def _street_address(self, t: str):
        return [m.span() for m in _ADDRESS.finditer(t)] + ([m.span() for m in _HAN_ADDRESS.finditer(t)] if _HAN.search(t) else [])

    def _person_name(self, t: str):
        out = []
        for m in _ANNOUNCED.finditer(t):
            parts = re.split(r"[\s,]+", m["name"])
            if parts[0].lower() in _NOT or parts[-1].lower() in _NOT:
                continue
            out.append(m.span("name"))
        for m in _TITLED.finditer(t):
            end = m.end()
            words = m[0].split()
            if len(words) == 3 and not (words[1] in self.given and words[2] in self.family):
                end = m.end() - len(words[2]) - 1
            out.append((m.start(), end))
        at = 0
        while m := _PAIR.search(t, at):
            a, b = m["a"], m["b"]
            if a in self.family and b in self.given if m["comma"] else a in self.given and b in self.family:
                out.append(m.span())
                at = m.end()
            else:
                at = m.start("b")
        if _HAN.search(t):
            out += [m.span("name") for m in _HAN_NAME.finditer(t)]
        return out


# Calling codes of one and of three digits by their first digits;
# all others have two.
CODES_1, CODES_3 = ("1", "7"), ("21", "22", "23", "24", "25", "26", "29", "35", "37", "38", "42", "50", "59", "67", "68", "69", "80", "85", "87", "88", "96", "97", "99")


def spoken_digits(text: str) -> str:
    """Digits of a number in figures, words ("double five") or both."""
    times, digits = 1, []
    for w in re.findall(r"[a-z]+|\d", text.lower()):
        if w in ("double", "triple"):
            times = 2 if w == "double" else 3
        else:
            digits.append(DIGIT_WORDS.get(w, w) * times)
            times = 1
    return "".join(digits)


def national(text: str) -> str:
    """A telephone number without its calling code and trunk zero."""
    digits = spoken_digits(text)
    t = text.strip().lstrip("(")
    if t.startswith("+") or digits.startswith("00"):
        d = digits if t.startswith("+") else digits[2:]
        return d[1 if d.startswith(CODES_1) else 3 if d.startswith(CODES_3) else 2 :].lstrip("0")
    return re.sub(r"^(?:65(?=\d{8}$)|0+)", "", digits)


def _narrow(text: str) -> str:
    return _HIDDEN.sub("", text).translate(_NARROW)


def entity(kind: str, text: str) -> str:
    """One form of an entity however it is written or spoken."""
    t = _narrow(text).lower()
    if kind == "email":
        t = re.sub(r"\s?[(\[]\s?at\s?[)\]]\s?| at ", "@", t)
        t = re.sub(r"\s?[(\[]\s?dot\s?[)\]]\s?| dot ", ".", t)
        return t.replace(" plus ", "+").replace(" underscore ", "_").replace(" dash ", "-").replace(" ", "")
    if kind == "phone":
        return national(t)
    if kind == "id_number":
        return re.sub(r"[^a-z0-9]", "", t)
    if kind == "person_name":
        if "," in t:
            family, _, given = t.partition(",")
            t = f"{given.strip()} {family.strip()}"
        return re.sub(r"\s+", " ", t.replace(".", " ")).strip()
    return re.sub(r"[^\w]+", " ", re.sub(r"\bblock\b", "blk", t)).strip()


@lru_cache(maxsize=200_000)
def _number(key: bytes, *parts) -> int:
    return int.from_bytes(hmac.new(key, "\x1f".join(map(str, parts)).encode(), hashlib.sha256).digest()[:8], "big")


@lru_cache(maxsize=100_000)
def enciphered(key: bytes, digits: str, tweak: str, base: int = 10) -> str:
    """Keyed permutation of the strings of one length over ``base`` signs
    (digits, or letters of base 26): a Feistel network over the two halves."""
    signs = "0123456789" if base == 10 else "abcdefghijklmnopqrstuvwxyz"
    if len(digits) < 2:
        shift = 1 + _number(key, "one", tweak, base) % (base - 1)
        return "".join(signs[(signs.index(c) + shift) % base] for c in digits)
    value = lambda part: sum(signs.index(c) * base**i for i, c in enumerate(reversed(part)))
    cut = len(digits) // 2
    sizes = [cut, len(digits) - cut]
    halves = [value(digits[:cut]), value(digits[cut:])]
    for step in range(8):
        side = step % 2
        halves[side] = (halves[side] + _number(key, "half", tweak, base, step, len(digits), halves[1 - side])) % base ** sizes[side]
    out = ""
    for v, n in zip(halves, sizes):
        part = ""
        for _ in range(n):
            v, k = divmod(v, base)
            part = signs[k] + part
        out += part
    return out


# Sounds that made-up words are put together from, and their ends
# by gender (none, female, male); characters of made-up Chinese given names.
ONSETS = "b br c cl d dr f fl g gr h j k l m n p pr qu r s st t tr v w".split()
VOWELS = "a e i o u ai ea ou".split()
ENDS = {"": ("en", "el", "is", "o"), "f": ("a", "ia", "ine", "elle"), "m": ("us", "or", "ian", "ard")}
HAN_SOUNDS = "安博承丹恩帆光海嘉君凯岚明宁朋青荣舒涛文晓雅泽展哲正之知卓子宇云远月悦致志中忠竹庄准紫宗祖作佐言彦燕阳瑶烨怡艺亦逸意音英"
HAN_STREETS = "松云桂清梅竹柏枫荷兰菊莲桃柳榕桐杉槐樟茶"
_SAME_WORDS = frozenset(w.lower() for w in (*TITLES_M, *TITLES_F, *TITLES_N, *LINKS))
_STREET_WORDS = frozenset(w.lower().rstrip("?.") for w in (*STREETS, *STREETS_FIRST)) | frozenset("block blk no unit singapore s satu dua tiga empat lima jl".split())
# Second parts of domain endings.
_SECOND = frozenset("com gov edu org net co ac or go mil".split())
_SPOKEN_SIGNS = frozenset("at dot plus underscore dash".split())


def _cased(word: str, like: str) -> str:
    return word.upper() if like.isupper() and len(like) > 1 else word.capitalize() if like[:1].isupper() else word


@lru_cache(maxsize=100_000)
def made_word(key: bytes, word: str, what: str, attempt: int, gender: str = "") -> str:
    """A keyed word in lower case. The stem is that of the word, ``what`` and
    the attempt alone; only its end shows the gender."""
    n = _number(key, "word", what, word, attempt)
    out = ""
    for _ in range(3 if len(word) > 3 else 2):
        n, a = divmod(n, len(ONSETS))
        n, b = divmod(n, len(VOWELS))
        out += ONSETS[a] + VOWELS[b]
    ends = ENDS[gender]
    return out + ONSETS[n % len(ONSETS)][0] + ends[n // 64 % len(ends)]


def _figures(key: bytes, digits: str, tweak: str, attempt: int) -> str:
    """Digits enciphered; a first digit other than zero stays other than zero."""
    new = enciphered(key, digits, f"{tweak}{attempt}")
    while len(digits) > 1 and digits[0] != "0" and new[0] == "0":
        new = enciphered(key, new, f"{tweak}{attempt}")  # walks the cycle, so it stays a permutation
    return new


def _refilled(text: str, digits: str) -> str:
    """``text`` with its digits, from the last one back, replaced by ``digits``;
    full-width ones stay full width."""
    out, left = [], list(digits)
    for ch in reversed(text):
        plain = chr(_NARROW.get(ord(ch), ord(ch)))
        if plain.isdigit() and plain.isascii() and left:
            new = left.pop()
            ch = chr(ord(new) + 0xFEE0) if ch != plain else new
        out.append(ch)
    return "".join(reversed(out))


def gender_of(text: str) -> str:
    """f, m or nothing, from titles and connectors of a name."""
    words = set(re.findall(r"[a-z/]+", text.lower()))
    return "f" if words & {*(w.lower() for w in TITLES_F), "binti", "d/o", "a/p"} else "m" if words & {*(w.lower() for w in TITLES_M), "bin", "s/o", "a/l"} else ""


def _given_part(text: str) -> str:
    """The given name inside a mention, in lower case, or nothing."""
    t = _narrow(text).lower()
    if _HAN.search(t):
        return ""
    if "," in t:
        return t.partition(",")[2].strip()
    words = [w for w in re.split(r"[\s.]+", t) if w and w not in _SAME_WORDS]
    return words[0] if len(words) > 1 else ""


def surrogate(key: bytes, kind: str, text: str, attempt: int = 0, gender: str | None = None) -> str:
    """A replacement of the same kind, format, script and case as ``text``."""
    plain = _narrow(text)
    if kind == "phone":
        own = national(plain)
        new = _figures(key, own, "phone", attempt)
        new = own[0] + enciphered(key, own[1:], f"phone{own[0]}{attempt}") if len(own) > 2 else new
        if re.search("[A-Za-z]", plain):
            names = {d: w for w, d in reversed(DIGIT_WORDS.items()) if w != "oh"}
            said = " ".join(names[d] for d in spoken_digits(plain)[: -len(new) or None] + new)
            return said.upper() if plain.isupper() else said
        return _refilled(_HIDDEN.sub("", text), new)
    if kind == "id_number":
        who = entity(kind, text)
        figures = iter(_figures(key, re.sub(r"\D", "", who), "id", attempt))
        letters = iter(enciphered(key, re.sub(r"\d", "", who), f"id{attempt}", 26))
        out = []
        for ch in _HIDDEN.sub("", text):
            flat = chr(_NARROW.get(ord(ch), ord(ch)))
            if flat.isascii() and flat.isdigit():
                out.append(chr(ord(new) + 0xFEE0) if (new := next(figures)) and ch != flat else new)
            elif flat.isascii() and flat.isalpha():
                new = next(letters)
                out.append(new.upper() if flat.isupper() else new)
            else:
                out.append(ch)
        return "".join(out)
    if kind == "email":
        return _new_email(key, plain, attempt)
    if kind == "street_address":
        return _new_address(key, plain, attempt)
    if _HAN.search(plain):
        family, given = plain[0], plain[1:]
        place = HAN_FAMILY.find(family)
        shift = 1 + _number(key, "family", attempt) % (len(HAN_FAMILY) - 1)
        family = HAN_FAMILY[(place + shift) % len(HAN_FAMILY)]
        return family + "".join(HAN_SOUNDS[_number(key, "given", given, i, attempt) % len(HAN_SOUNDS)] for i in range(len(given)))
    gender = gender_of(plain) if gender is None else gender
    words = re.findall(r"[A-Za-z][A-Za-z'/-]*", plain)
    parts = [w for w in words if w.lower() not in _SAME_WORDS]
    titled = any(w.lower() in _SAME_WORDS - set(LINKS) for w in words)
    at = iter(range(len(parts)))

    def new(m: re.Match) -> str:
        w = m[0]
        if w.lower() in _SAME_WORDS:
            return w
        k = next(at)
        family = (k == 0) if "," in plain else k == len(parts) - 1 and (len(parts) > 1 or titled)
        return _cased(made_word(key, w.lower(), "family" if family else "given", attempt, "" if family else gender), w)

    return re.sub(r"[A-Za-z][A-Za-z'/-]*", new, plain)


def _new_piece(key: bytes, piece: str, what: str, attempt: int) -> str:
    """Letters as a word, digits enciphered, in their order."""
    return re.sub(r"[A-Za-z]+|\d+", lambda m: _figures(key, m[0], what, attempt) if m[0].isdigit() else _cased(made_word(key, m[0].lower(), what, attempt), m[0]), piece)


def _new_email(key: bytes, text: str, attempt: int) -> str:
    pieces = re.findall(r"[A-Za-z0-9]+|[^A-Za-z0-9]+", text)
    where = [i for i, p in enumerate(pieces) if p[0].isalnum()]
    signs = set()
    for i in where:  # spoken signs stand between blanks or brackets
        around = (pieces[i - 1][-1:] if i else "", pieces[i + 1][:1] if i + 1 < len(pieces) else "")
        if pieces[i].lower() in _SPOKEN_SIGNS and all(c and c in " ([])" for c in around):
            signs.add(i)
    labels = [i for i in where if i not in signs]
    keep = {labels[-1]} | ({labels[-2]} if len(labels) > 3 and len(pieces[labels[-1]]) == 2 and pieces[labels[-2]].lower() in _SECOND else set())
    return "".join(p if i in keep or i not in labels else _new_piece(key, p, "email", attempt) for i, p in enumerate(pieces))


def _new_address(key: bytes, text: str, attempt: int) -> str:
    if _HAN.search(text):
        name = lambda m: "".join(HAN_STREETS[_number(key, "street", m[0], i, attempt) % len(HAN_STREETS)] for i in range(len(m[0])))
        text = re.sub("^[一-鿿]{2}", name, text)
        return re.sub(r"\d+", lambda m: _figures(key, m[0], "house", attempt), text)

    def new(m: re.Match) -> str:
        w = m[0]
        if w[0].isdigit():
            figures = re.match(r"\d+", w)[0]
            return _figures(key, figures, "house", attempt) + w[len(figures) :]
        return w if w.lower() in _STREET_WORDS else _cased(made_word(key, w.lower(), "street", attempt), w)

    return re.sub(r"[A-Za-z][A-Za-z']*|\d+[A-Za-z]?(?![\w])|\d+", new, text)


def replacements(text: str, spans: list[tuple[int, int, str]], key: bytes, placeholders: bool) -> list[str]:
    """What stands in place of every span.

    Placeholders are <kind_n>, n numbering the kind's entities in the text by
    first mention. A surrogate that another entity of the text has or is makes
    its entity be drawn again, for all its mentions.
    """
    whos = [(kind, entity(kind, text[a:b])) for a, b, kind in spans]
    if placeholders:
        numbers: dict[tuple[str, str], int] = {}
        count: dict[str, int] = {}
        for who in whos:
            if who not in numbers:
                numbers[who] = count[who[0]] = count.get(who[0], 0) + 1
        return [f"<{who[0]}_{numbers[who]}>" for who in whos]
    genders: dict[str, str] = {}
    for a, b, kind in spans:
        if kind == "person_name" and (g := gender_of(_narrow(text[a:b]))):
            genders.setdefault(_given_part(text[a:b]), g)
    genders.pop("", None)
    originals = set(whos)
    attempts: dict[tuple[str, str], int] = {}
    used: dict[tuple[str, str], tuple[str, str]] = {}
    out = []
    for (a, b, kind), who in zip(spans, whos):
        mention = text[a:b]
        gender = genders.get(_given_part(mention)) if kind == "person_name" else None
        attempt = attempts.get(who, 0)
        while True:
            new = surrogate(key, kind, mention, attempt, gender)
            form = (kind, entity(kind, new))
            if form not in originals and used.setdefault(form, who) == who or who in attempts:
                break
            attempt += 1
        attempts[who] = attempt
        out.append(new)
    return out


def rewrite(text: str, spans: list[tuple[int, int, str]], key: bytes, placeholders: bool) -> str:
    """``text`` with every span replaced; the rest is unchanged."""
    out, at = [], 0
    for (a, b, _), new in zip(spans, replacements(text, spans, key, placeholders)):
        out += [text[at:a], new]
        at = b
    return "".join([*out, text[at:]])


def _finder(names: DataFrame, part: str, kind: str) -> list[tuple[str, str]]:
    rows = fits(names.select(F.trim(part).alias("p"), F.lower(F.trim(kind)).alias("k")).filter("p <> ''").distinct(), MAX_NAMES, ["p", "k"])
    if rows is None:
        raise ValueError(f"more than {MAX_NAMES} name parts")
    return [(r["p"], r["k"]) for r in rows]


def mentions(docs: DataFrame, key: str, text: str, names: DataFrame, secret: str) -> DataFrame:
    """(key, kind, occurrence_no, start, end, surrogate) of every mention.

    occurrence_no counts the mentions of a kind in a text from 1, repeated
    mentions included; ``surrogate`` is what the replacing pass writes. Null and
    empty texts have none. ``names`` (at most MAX_NAMES parts, else ValueError)
    has name_part and kind.
    """
    shared = docs.sparkSession.sparkContext.broadcast(_finder(names, "name_part", "kind"))
    slim = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("t")).filter("key is not null and t is not null")
    schema = schema_with(slim, ["key"], kind=T.StringType(), occurrence_no=T.IntegerType(), start=T.IntegerType(), end=T.IntegerType(), surrogate=T.StringType())
    secret_key = secret.encode()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(shared.value)
        for batch in batches:
            rows = []
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                count: dict[str, int] = {}
                spans = finder.find(t)
                for (a, b, kind), new in zip(spans, replacements(t, spans, secret_key, False)):
                    count[kind] = count.get(kind, 0) + 1
                    rows.append((k, kind, count[kind], a, b, new))
            if rows:
                types = [batch.schema.field(0).type, pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=schema.fieldNames())

    return slim.mapInArrow(run, schema).withColumnRenamed("key", key)


def replaced(docs: DataFrame, key: str, text: str, names: DataFrame, secret: str, placeholders: bool) -> DataFrame:
    """(key, text) with typed placeholders or keyed surrogates; nulls stay."""
    shared = docs.sparkSession.sparkContext.broadcast(_finder(names, "name_part", "kind"))
    slim = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    secret_key = secret.encode()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(shared.value)
        for batch in batches:
            new = [None if t is None else rewrite(t, finder.find(t), secret_key, placeholders) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(new, pa.string())], names=["key", "text"])

    return slim.mapInArrow(run, schema_with(slim, ["key", "text"])).withColumnRenamed("key", key)


def secret_of(spark: SparkSession) -> str:
    """The key of the replacements: spark.undertone.surrogate.key; sessions
    without it (tests) have a known one."""
    return spark.conf.get("spark.undertone.surrogate.key", "no secret: set spark.undertone.surrogate.key")


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mentions(table(spark, sf_dir, "documents"), "doc_id", "text", table(spark, sf_dir, "name_list"), secret_of(spark)).select("doc_id", "kind", "occurrence_no")


def p10_redacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replaced(table(spark, sf_dir, "documents"), "doc_id", "text", table(spark, sf_dir, "name_list"), secret_of(spark), True)


def p10_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replaced(table(spark, sf_dir, "documents"), "doc_id", "text", table(spark, sf_dir, "name_list"), secret_of(spark), False)
