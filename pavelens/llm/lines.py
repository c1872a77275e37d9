"""What kind of line a line of a commit is: list, table, junk or none of these."""

from __future__ import annotations

import re
import unicodedata


class _Plain(dict):
    """Other shapes of letters (full width, mathematical, ligatures) as the letters that they stand for."""

    def __missing__(self, o: int) -> str:
        c = chr(o)
        self[o] = plain = unicodedata.normalize("NFKC", c) if o > 0x24F and (c.isalpha() or 0xFF00 < o < 0xFF5F or o == 0x3000) else c
        return plain


_PLAIN = _Plain()

#: Order of the counts that line_counts() returns. doubtful: letters that hardly form words, and lines without function words
#: next to junk; whether they are junk is told by how far the whole text is from prose.
KINDS = ("none", "list", "table", "junk", "doubtful")
NONE, LIST, TABLE, JUNK, DOUBTFUL = range(5)

_HUNK = re.compile(r"^@@ -\d+(?:,(\d+))? \+\d+(?:,(\d+))? @@")
_ITEM = re.compile(r"\s*(?:[-*+•‣◦·–—▪▫●○■□➤→✓✔✗☐☑☒](?:\s+\[[ xX]?\])?|\(?\d{1,3}[.)]|\(?[A-Za-z][.)]|\(?[ivxIVX]{1,5}[.)]|\[[ xX]?\]|[☐☑☒])\s+\S")
_HEADER = re.compile(
    r"(?:commit [0-9a-f]{7,40}\b|From [0-9a-f]{7,40} |[A-Z][A-Za-z-]{1,24}: |Merge[: ]|Conflicts:|diff --|index [0-9a-f]|--- |\+\+\+ |---$|-- $|--$"
    r"|(?:new|deleted) file mode|(?:old|new) mode|(?:similarity|dissimilarity) index|rename (?:from|to)|copy (?:from|to)|GIT binary|literal \d|delta \d"
    r"|Binary files|Index: |\((?:cherry picked|backported|reverted) from |r\d+ \| \S+ \| |@@|\\ No newline|#\s*Conflicts|# )"
)
_PATH = re.compile(r"\s*(?:(?:modified|deleted|new file|renamed|both modified):\s+)?[\w.@~+-]*(?:/[\w.@~+-]+)+/?\s*$")
_RULE = re.compile(r"\s*(?:[|+][-=:|+\s]*[|+]|\|?\s*:?-{2,}:?(?:\s*[|+]\s*:?-{2,}:?)+\s*\|?|[-=]{2,}(?:\s+[-=]{2,})+)\s*$")
_WORD = re.compile(r"[^\W\d_]+")
_GAP = re.compile(r"\S(?: {2,}|\t+)(?=\S)")
_ESCAPES = re.compile(r"(?:\\x[0-9a-fA-F]{2}|\\[0-7]{3}|\\u[0-9a-fA-F]{4}|%[0-9a-fA-F]{2}|&#x?[0-9a-fA-F]+;)")
_HEX = re.compile(r"\s*(?:0x)?[0-9a-fA-F]{4,}:?(?:\s+(?:0x)?[0-9a-fA-F]{2,8},?)*\s*(?:\|?.{0,20}\|?)?\s*$")
_HEX_PAIRS = re.compile(r"(?:0x)?\b[0-9a-fA-F]{2}(?:[0-9a-fA-F]{2}){0,3}\b")
_VOWEL = re.compile(r"[aeiouyäöüàâéèêëîïôûAEIOUYÄÖÜ]")
_CONSONANTS = re.compile(r"[bcdfghjklmnpqrstvwxzßBCDFGHJKLMNPQRSTVWXZ]{6,}")
_SWITCH = re.compile(r"[a-z][A-Z]|[A-Z]{2}[a-z]|[A-Za-z]\d|\d[A-Za-z]")
# Frequent function words of English and German; prose has them, tables, lists of names and junk don't.
COMMON = {
    "en": frozenset("the a an and or but of to in on at by for from with without into under over near before after during is are was were be been it its this that these those their our we you they he she not no do does did because since when while if unless until so as than then now each every some any one".split()),
    "de": frozenset("der die das den dem des ein eine einen einem einer eines und oder aber von zu in im am an auf aus bei mit ohne unter über nach vor für ist sind war wird werden es sich dieser diese dieses jeder jede jedes kein keine keinen nicht nur noch weil wenn während obwohl damit denn als dass wir sie er ich man doch immer".split()),
}
_FUNCTION = COMMON["en"] | COMMON["de"]
_CELL = re.compile(r"[\w .%+:#/()'-]{0,40}$")
# what letters struck at random have and words hardly ever have
_STRUCK = re.compile(r"q(?![u\W_])|j(?![aeiouyäöü\W_])|[fghjklmpqsvwxz]j|;(?=[a-z'])|(?<=[a-z]);'|x[bdfgjkqz]|w[fgjqvxz]|[vz][bdfgjkpqx]")
_CLUSTER = re.compile(r"[bcdfghjklmnpqrstvwxz]{4,}")
_SOUND = re.compile(r"sch|tch|ch|ck|th|ph|str|spr|ng|nk|ss|ll|tt|mm|nn|pp|rr|ff")
_GERMAN = frozenset("äöüÄÖÜß–—„“”‚‘’…•‣◦·▪●→✓☐☑☒€§°«»")


def _cells(line: str) -> bool:
    """Whether the line is a row of cells set apart by separators or alignment."""
    s = line.strip()
    if "|" in s and (s.count("|") >= 2 or s[0] == "|"):
        parts = [p.strip() for p in s.strip("|").split("|")]
        return sum(bool(_CELL.match(p)) for p in parts) >= 0.8 * len(parts) and sum(map(len, parts)) > 0
    if "\t" in s:
        return len([p for p in s.split("\t") if p.strip()]) >= 2
    for sep in ";,":
        if s.count(sep) >= 2 and f"{sep} " not in s:
            parts = s.split(sep)
            if all(len(p) <= 24 and len(p.split()) <= 2 and _CELL.match(p) for p in parts) and not _struck(s.replace(sep, " ")):
                return True
    if _GAP.search(s) and s[0] != ">":
        parts = [p.split() for p in s.split("  ") if p.strip()]
        if all(len(p) <= 2 for p in parts) and s[-1] not in ".!?:;":
            return sum(w.lower() in _FUNCTION for p in parts for w in p) < 2 and not _struck(s)
    return False


def _prose(line: str) -> bool:
    """Whether two of the words are function words; nothing but sentences has them."""
    n = 0
    for w in line.lower().split():
        if w in _FUNCTION:
            n += 1
            if n == 2:
                return True
    return False


def _struck(s: str) -> bool:
    """Whether the letters look struck at random."""
    low = s.lower()
    n = sum(map(len, _WORD.findall(low)))
    return n >= 6 and len(_STRUCK.findall(low)) + len(_CLUSTER.findall(_SOUND.sub("s", low))) >= max(1, 0.06 * n)


def _broken(s: str) -> bool:
    """Whether three tenths of the characters are none that a text in Latin letters has."""
    dense = "".join(s.split())
    return sum(1 for c in dense if ord(c) > 127 and c not in _GERMAN) + dense.count("\ufffd") >= 0.3 * len(dense)


def _garbled(s: str) -> int:
    """JUNK for encoded or dumped bytes, runs of symbols and broken characters, DOUBTFUL for letters that hardly form words, else NONE."""
    dense = "".join(s.split())
    n = len(dense)
    if not n:
        return NONE
    letters = _WORD.findall(s)
    k = sum(map(len, letters))
    if any(ord(c) < 32 for c in dense):
        return JUNK
    if n >= 4 and not any(c.isalnum() for c in dense):
        return JUNK
    esc = _ESCAPES.findall(s)
    if len(esc) >= 3 and sum(map(len, esc)) >= 0.5 * n:
        return JUNK
    pairs = _HEX_PAIRS.findall(s)
    if len(pairs) >= 6 and sum(map(len, pairs)) >= 0.6 * n:
        return JUNK
    tokens = s.split()
    longest = max(tokens, key=len)
    m = len(longest)
    if m >= 12 and m >= 0.6 * n and not ("." in longest and _PATH.match(longest)) and "://" not in longest:
        if re.fullmatch(r"[0-9a-fA-F]+", longest) and re.search(r"\d", longest):
            return JUNK if m >= 16 else NONE
        runs = len(_SWITCH.findall(longest))
        marks = sum(1 for c in longest if not c.isalnum() and c not in "_-./")
        if runs >= m / 8 or runs + marks >= m / 6:
            return JUNK
    if k and k < 0.5 * n and sum(1 for c in dense if not c.isalnum()) >= 0.5 * n and n >= 8:
        return JUNK
    words = [w for w in letters if len(w) >= 3]
    if words and k >= 0.5 * n:
        bad = sum(1 for w in words if not _VOWEL.search(w) or _CONSONANTS.search(w))
        if len(words) >= 2 and bad >= 0.5 * len(words) or _struck(s) and not any(w.lower() in _FUNCTION for w in words):
            return DOUBTFUL
    return NONE


def line_kinds(text: str) -> list[int]:
    """The kind of each non-blank line, as an index into KINDS."""
    out: list[int] = []
    open_: list[int] = []  # lines of no kind that aren't marks of a commit or diff and have no function word
    old = new = 0
    before = ""
    if not text.isascii():
        text = text.translate(_PLAIN)
    lines = text.replace("\r\n", "\n").replace("\r", "\n").split("\n")
    for line in lines:
        if not line or line.isspace():
            continue
        c = line[0]
        if old > 0 or new > 0:
            if c in " +-\\\t":
                old -= c in " -\t"
                new -= c in " +\t"
                out.append(0)
                before = line
                continue
            old = new = 0
        if c == "@" and (m := _HUNK.match(line)):
            old, new = int(m[1] or 1), int(m[2] or 1)
            out.append(0)
        elif _HEADER.match(line):
            out.append(0)
        elif before.startswith("Index: ") and set(line.strip()) <= set("=_-"):
            out.append(0)
        elif _ITEM.match(line):
            out.append(1)
        elif "|" not in line and "\t" not in line and "  " not in line.strip() and _prose(line):
            out.append(0)
        elif not line.isascii() and _broken(line):
            out.append(3)
        elif "." in line and _PATH.match(line):
            out.append(0)
        elif out and out[-1] == 2 and set(line.strip()) <= set("-=_"):
            out.append(2)
        elif _RULE.match(line):
            out.append(2)
        elif _cells(line) and not _ESCAPES.match(line.strip()):
            out.append(2)
        elif (garbled := _garbled(line)) != NONE:
            out.append(garbled)
        else:
            if not any(w.lower() in _FUNCTION for w in _WORD.findall(line)):
                open_.append(len(out))
            out.append(0)
        before = line
    # such a line next to junk may be more of it
    for i in open_:
        if i and out[i - 1] >= JUNK:
            out[i] = DOUBTFUL
    for i in reversed(open_):
        if out[i] == NONE and i + 1 < len(out) and out[i + 1] >= JUNK and i and (i - 1 in open_ or out[i - 1] >= JUNK):
            out[i] = DOUBTFUL
    return out


def line_counts(text: str) -> tuple[int, ...]:
    k = line_kinds(text)
    return tuple(map(k.count, range(len(KINDS))))
