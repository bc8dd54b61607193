"""Sentence boundaries across languages and scripts.

The characters of a block (text between blank lines) are tagged by a linear-chain
model with Viterbi decoding. A character is inside a sentence, at its boundary,
or quoted: within a quotation or bracket, where a mark may end a sentence of the
quotation but none of the text. Only closing marks, the spaces of scripts that
write none, the starts of list items and the edges of quotations can change the
tag; all other characters carry on the one before, so the chain is decoded over
those places. What a mark says for itself and what its neighbours say are weighed
against each other: a mark after which each sentence could end does not end one
while the chain is quoted, or where only marks stand between two boundaries.

All weights, of the features of places and of the steps between tags, are trained
here, by an averaged structured perceptron on the labelled lines of
sentence_seed, those of the unpunctuated scripts with all punctuation stripped.
"""

from __future__ import annotations

import bisect
import functools
import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyspark.sql.types as T
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm import sentence_seed as seed
from cadenza.llm.encode import bound_batches

LINE_END = r"(?:\r\n|[\n\r\x0b\x0c\x85\u2028\u2029])"
BLANK = re.compile(rf"{LINE_END}[^\S\n\r\x0b\x0c\x85\u2028\u2029]*{LINE_END}\s*")
DOTS = ".…‥．"
#: Marks that end a sentence in any script, by their Unicode property; the little section of Burmese is its comma.
STRONG = "".join(c for c in regex.findall(r"\p{Sentence_Terminal}", "".join(map(chr, [*range(0xD800), *range(0xF900, 0x10000)]))) if c not in DOTS + "၊")
STRONG_SET = frozenset(STRONG)
ABBREVIATED = seed.NEVER_LAST | seed.BEFORE_NUMBER | seed.MAYBE_LAST
GREEK_ASKS = r"(?<=[\u0370-\u03ff\u1f00-\u1fff])[;\u037e]"
ENDS = re.compile(rf"(?:[{re.escape(STRONG + DOTS)}]|{GREEK_ASKS})(?:[{re.escape(STRONG + DOTS)}]|[ \u00a0\u202f](?=[!?]))*")
QUOTES = {"“": "”", "„": "“”", "«": "»", "»": "«", "「": "」", "『": "』", "‘": "’", '"': '"', "'": "'", "‚": "‘’"}
BRACKETS = {"(": ")", "[": "]", "{": "}", "（": "）", "【": "】", "《": "》", "〈": "〉", "［": "］"}
MORE = re.compile(rf"\s*[{re.escape(STRONG)}]")
NEXT_WORD = re.compile(r"[\w\-'’]+")
LINE = re.compile(LINE_END)
MARKS = re.compile("[" + re.escape("".join(QUOTES) + "”’」』" + "".join(BRACKETS) + "".join(BRACKETS.values())) + "]")
OPENING = set(QUOTES) | set(BRACKETS) | set("¿¡—–")
#: Scripts whose sentences end at spaces, and those where they do in a block without their own marks.
SPACED = re.compile(r"[฀-๿຀-໿]")
SPACED_BARE = re.compile(r"[က-႟ក-៿]")
THAI_SPACE = re.compile(r"[^\S\n\r\x0b\x0c\x85\u2028\u2029]+")
NOISE = re.compile(r"[\s\u200b-\u200f\u2060\ufeff️\U0001F1E6-\U0001F1FF\U0001F300-\U0001FAFF☀-➿]*")
SPACES = re.compile(r"[\s\u200b\u2060\ufeff]*")
WORD = re.compile(r"[^\W_]+(?:[-'’·][^\W_]+)*")
BEFORE = re.compile(r"[\w.\-/’'̀-ͯऀ-ॿ]*$")
LIST = re.compile(r"[^\S\n\r]*(?:(\d{1,3})[.)]|([^\W\d_])[.)])(?=\s)")
INNER_END = re.compile(r"[\s”’\"'」』»)）]+$")
ELIDED = re.compile(r"(?:l|d|un|dell|all|nell|sull|dall|qu|quell)['’](\w{2,})$")
SHORT = re.compile(r"(?<!\S)(\S{1,6})\.(?=\s)")
DASH = re.compile(r"[—–]")


def _cased(c: str) -> bool:
    return c.lower() != c.upper()


#: Closing mark -> the opening marks it can close.
CLOSES: dict[str, list[str]] = defaultdict(list)
for _opener, _closers in (QUOTES | BRACKETS).items():
    for _c in _closers:
        CLOSES[_c].append(_opener)


def _trimmed(s: str, e: int) -> int:
    """Place after the last character before e that is not white space."""
    while e and s[e - 1].isspace():
        e -= 1
    return e


def _inside(spans: list[tuple[int, int]], i: int) -> bool:
    """Is place i strictly within one of the disjoint, ordered spans?"""
    k = bisect.bisect_left(spans, (i, -1)) - 1
    return k >= 0 and spans[k][0] < i < spans[k][1]


def _pairs(s: str) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Outermost (open, close) places of quotations and of brackets; marks without a partner are ordinary characters."""
    stack: list[tuple[str, int]] = []
    held: dict[str, list[int]] = defaultdict(list)  # opening mark -> its places in the stack
    found: list[tuple[int, int, bool]] = []
    for m in MARKS.finditer(s):
        i, c = m.start(), m.group()
        before, after = s[i - 1 : i], s[i + 1 : i + 2]
        if c in "'’" and before.isalnum() and after.isalnum():
            continue  # an apostrophe
        close = max((held[o][-1] for o in CLOSES.get(c, ()) if held[o]), default=None)
        if c == "'" and close is not None and (before.isspace() or after.isalnum()):
            close = None
        if close is not None:
            opened, at = stack[close]
            while len(stack) > close:
                held[stack.pop()[0]].pop()
            found.append((at, i, opened in QUOTES))
        elif c in QUOTES or c in BRACKETS:
            if c == "'" and not ((not before or not before.isalnum()) and after and not after.isspace()):
                continue
            if c == "»" and (not after or after.isspace()):
                continue
            held[c].append(len(stack))
            stack.append((c, i))
    outer_q, outer_b, end = [], [], -1
    for a, b, quote in sorted(found):
        if a > end:
            (outer_q if quote else outer_b).append((a, b))
            end = b
    return outer_q, outer_b


def _dialogue(s: str, starts: set[int], quotes: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """(from, to) of quotations opened by a dialogue dash: up to the dash before the reporting words, else to the line's end."""
    dashes = [m.start() for m in DASH.finditer(s)]
    if not dashes:
        return []
    # from the last dash back: where a line that is open before this one ends, None if nowhere before the line itself does
    goes_on: list[int | None] = [None]
    for i in reversed(dashes):
        said = s[(k := SPACES.match(s, i + 1).end()) : k + 1]
        left = i
        while left and s[left - 1] in " \t":
            left -= 1
        if said.islower() or (said and said in ".,;:") or (said.isalpha() and not _cased(said)):
            goes_on.append(i)
        elif not left or s[left - 1] in "\n\r" or s[left - 1] in STRONG + DOTS:
            goes_on.append(None)
        else:
            goes_on.append(goes_on[-1])
    goes_on.reverse()
    out, at = [], 0
    for n, i in enumerate(dashes):
        if i < at or _inside(quotes, i):
            continue
        left = _trimmed(s, i)
        opened = not left or s[left - 1] in STRONG + DOTS + "»”\"'」" or i in starts
        k = SPACES.match(s, i + 1).end()
        after = s[k : k + 1]
        if not opened or not after or not (after.isalpha() or after in "¿¡"):
            continue
        end = goes_on[n + 1]
        if end is None:
            stop = LINE.search(s, i)
            end = stop.start() if stop else len(s)
        out.append((i, end))
        at = end + 1
    return out


def _lists(s: str) -> dict[int, int]:
    """Places of list numbers and letters -> end of their mark: at the block's start, or continuing a list by one."""
    out: dict[int, int] = {}
    last: int | None = None
    at = 0
    while True:
        m = LIST.match(s, at)
        if m:
            n = int(m[1]) if m[1] else ord(m[2].lower()) - 96
            if (not out and (at == 0 or n == 1)) or (last is not None and n == last + 1):
                start = m.start() + len(m.group()) - len(m.group().lstrip())
                out[start] = m.end()
                last = n
        line = LINE.search(s, at)
        if not line:
            return out
        at = line.end()


def _says(s: str, a: int) -> bool:
    """Do the words from a on report the quotation before them?"""
    rest = unicodedata.normalize("NFC", s[a : a + 90])
    rest = SHORT.sub(lambda m: m[1] if m[1].lower() in seed.NEVER_LAST or len(m[1]) == 1 else m[0], rest)
    stop = re.search(rf"[{re.escape(STRONG)}]|[.](?=\s|$)|[:：]\s*[{re.escape(''.join(QUOTES))}]|[,]\s*[{re.escape(''.join(QUOTES))}]", rest)
    clause = rest[: stop.start()] if stop else rest
    if stop and stop.group()[0] in ":：,":
        # words that introduce another quotation, unless they begin with the verb
        first = WORD.match(clause)
        if not (first and first.group() in seed.SPEECH and stop.group()[0] == ","):
            return False
    if re.search(r"[぀-ヿ一-鿿]", clause):
        return bool(re.match(r"[とっは、がをにもの]", clause)) or any(v in clause[:16] for v in seed.SPEECH_CJK)
    words = [w.group().lower() for w in WORD.finditer(re.sub(r"[ऀ-ःऺ-ॏ]", "", clause) if re.search(r"[ऀ-ॿ]", clause) else clause)][:5]
    return any(w in seed.SPEECH or w in seed.SPEECH_BARE for w in words)


#: Kinds of places: one that may be a boundary, the start of a quotation or bracket, its end.
MAY, OPENS, SHUTS = 0, 1, 2
Place = tuple[int, int, tuple[str, ...], int]  # end of the left sentence, start of the right one, features, kind


def places(s: str) -> list[Place]:
    """The places of block s where the tag can change, in the order of the characters that make them."""
    quotes, brackets = _pairs(s)
    lists = _lists(s)
    spoken = _dialogue(s, set(lists.values()) | {SPACES.match(s, e).end() for e in lists.values()}, quotes)
    shut: list[tuple[int, int]] = []
    for a, b in sorted(quotes + brackets + spoken):  # the outermost
        if not shut or a > shut[-1][1]:
            shut.append((a, b))
    outer = dict(shut)
    heads = {i for i in lists}
    list_dots = {e - 1 for e in lists.values()}
    out: list[tuple[int, int, Place]] = []  # character, rank among those of one character, place
    for m in ENDS.finditer(s):
        i, e = m.start(), m.end()
        if i in list_dots or (not s[e : e + 2].strip().isalnum() and MORE.match(s, e, e + 3)):
            continue
        out.append((i, 1, (*_mark(s, i, e, heads), MAY)))
    closed = set()
    for a, b in quotes:
        e = b + 1
        inner = INNER_END.sub("", s[a + 1 : b])
        nxt = SPACES.match(s, e).end()
        if not inner or inner[-1] not in STRONG + DOTS:
            continue
        if s[nxt : nxt + 1] in tuple(",，、;；:：،") or ENDS.match(s, e):
            continue
        end, start, feats = _quote(s, a, e, nxt, heads)
        if outer.get(a) == b and feats:
            closed.add(a)
            feats += ("shut",)
        out.append((b, 0, (end, start, feats, MAY)))
    for a, b in spoken:  # a spoken line without reporting words ends with its line
        if b < len(s) and not DASH.match(s, b):
            last = outer.get(a) == b
            if last:
                closed.add(a)
            out.append((b, 0, (b, SPACES.match(s, b).end(), ("quote", "q_alone") + ("shut",) * last, MAY)))
    for a, b in shut:
        out.append((a, 0, (a, a, ("open",), OPENS)))
        if a not in closed:
            e = b if (a, b) in spoken else b + 1
            out.append((b, 0, (e, e, ("shut",), SHUTS)))
    ascii = s.isascii()
    spaced = SPACED if not ascii and SPACED.search(s) else None
    if not ascii and SPACED_BARE.search(s) and not re.search("[។៕၊။]", s):
        spaced = re.compile(SPACED.pattern[:-1] + SPACED_BARE.pattern[1:])
    if spaced:
        for m in THAI_SPACE.finditer(s):
            i, e = m.span()
            a, b = s[i - 1 : i], s[e : e + 1]
            if not a or not b or not (spaced.match(a) or spaced.match(b)) or a.isspace() or b.isspace() or a in STRONG + DOTS:
                continue
            feats = ["space"]
            if any(c.isdigit() or (c.isalpha() and c.isascii()) or "LATIN" in _name(c) for c in (a, b)):
                feats.append("th_beside")
            if b in QUOTES and s[max(0, i - 3) : i] == "ว่า":
                feats.append("th_told")
            out.append((i, 1, (i, e, tuple(feats), MAY)))
    ends = {x[0] for _, _, x in out if x[3] == MAY and x[2]}
    for h in heads:  # a list item ends before the next one
        left = _trimmed(s, h)
        if left and not (s[left - 1] in STRONG + DOTS) and left not in ends:
            out.append((left - 1, 2, (left, h, ("item",), MAY)))
    out = [x for x in out if x[2][2]]
    out.sort()
    return [x[2] for x, y in zip(out, [None, *out]) if x != y]


@functools.lru_cache(maxsize=4096)
def _name(c: str) -> str:
    return unicodedata.name(c, "")


def _next(s: str, e: int, start: int, heads: set[int]) -> tuple[str, int, str]:
    """Kind of what follows place e, past white space (which ends at start) and emoji, its place and its first word."""
    j = start if s[start : start + 1].isalnum() else NOISE.match(s, e).end()
    if j >= len(s):
        return "end", j, ""
    c = s[j]
    if heads and (start in heads or j in heads):
        return "list", j, c
    if c in OPENING:
        return "open", j, c
    w = NEXT_WORD.match(s, j)
    word = w.group() if w else c
    if c.isdigit():
        return "digit", j, word
    if c.isalpha() and not _cased(c):
        return "bare", j, word
    if c.isupper() or c.istitle():
        return "cap", j, word
    if c.isalpha():
        rest = s[j + len(word) : j + len(word) + 14].lstrip()
        if any(x.isupper() or x.isdigit() for x in word[1:]):
            return "small", j, word
        if len(word) == 1 and (re.match(seed.LETTER_IS, rest) or word not in seed.ONE_LETTER):
            return "small", j, word
        return "low", j, word
    return "other", j, c


def _mark(s: str, i: int, e: int, heads: set[int]) -> tuple[int, int, tuple[str, ...]]:
    """Features of the place after the closing marks s[i:e]."""
    if e == i + 1:  # most places: a mark between a plain word and a capital, or between words of a script without spaces
        c, after = s[i], s[e : e + 1]
        if after == " " and e + 1 not in heads and ((x := s[e + 1 : e + 2]).isupper() or (x.isalpha() and not _cased(x))):
            if c in STRONG_SET:
                return e, e + 1, ("strong",)
            at = s.rfind(" ", max(0, i - 40), i) + 1
            if c == "." and at and (t := s[at:i]).isalpha() and t.isascii() and len(t) > 2 and t.lower() not in ABBREVIATED:
                return e, e + 1, ("dot",)
        elif c in STRONG_SET and after.isalpha() and not _cased(after) and e not in heads:
            return e, e, ("strong",)
    run = s[i] if e == i + 1 else "".join(s[i:e].split())
    start = e + 1 if s[e : e + 1] == " " and s[e + 1 : e + 2].isalnum() else SPACES.match(s, e).end()
    kind, j, word = _next(s, e, start, heads)
    glued = start == e and start < len(s)
    if kind == "end":
        return e, start, ()
    feats: list[str] = []
    prev = s[i - 1 : i]
    if run in STRONG or any(c in STRONG or c in ";\u037e" for c in run):
        feats.append("strong")
        if (kind in ("low", "other") or (glued and kind == "small")) and run[-1] in "!?.":
            feats.append("lower")
        return e, start, tuple(feats)
    dots = run.count(".") + 2 * (run.count("…") + run.count("‥"))
    if dots >= 2:
        bare = next((c for c in reversed(s[max(0, i - 200) : i]) if c.isalpha()), "a")
        opened = kind in ("cap", "list") or (kind == "open" and _cased(bare)) or (kind == "open" and word in "¿¡")
        feats += ["ellipsis", "e_open" if opened and _cased(bare) or kind == "list" else "e_on"]
        return e, start, tuple(feats)
    feats.append("dot")
    token = s[max(0, i - 40) : i]
    if token and not token[-1].isspace():
        token = token.split()[-1]
    if not (token.isalnum() and token.isascii()):
        token = BEFORE.search(token).group()
    if not token.isascii():
        token = unicodedata.normalize("NFC", token)
    if glued:
        plain = re.fullmatch(r"(?:[^\W\d_]['’])?[^\W\d_]{2,}[’'\-\w]*|\d+|[»”\"')\]]*", token.split(".")[-1]) and "_" not in token and "/" not in token
        following = s[e : e + 2]
        sentence = kind in ("cap", "open") and (kind == "open" or not following[1:2].isupper() and following[1:2] != ".") or (kind == "bare" and not (prev.isalpha() and prev.isascii())) or (kind == "digit" and plain and token.isalpha() and len(token) > 2 and not _abbreviation(token, kind, word))
        if not (plain and sentence and "." not in token) or prev.isspace():
            feats.append("embedded")
        return e, start, tuple(feats)
    if not prev or prev.isspace():
        if kind == "digit" and glued:
            feats.append("embedded")
    if (abbr := _abbreviation(token, kind, word, s[j + len(word) : j + len(word) + 1])) and token:
        feats.append(abbr)
    elif token.isdigit() and len(token) <= 2 and kind == "cap":
        lead = s[max(0, i - len(token) - 8) : i - len(token)].rstrip().split()
        if lead and lead[-1].lower() in seed.ORDINAL_AFTER and s[i - len(token) - 1 : i - len(token)].isspace():
            feats.append("ordinal")
    if kind in ("low", "other"):
        feats.append("lower")
    return e, start, tuple(feats)


def _abbreviation(token: str, kind: str, word: str, after: str = "") -> str:
    """'' or the feature of the abbreviation before a dot."""
    t = token.lower().strip("’'-(")
    if not t:
        return ""
    if (elided := ELIDED.match(t)) and elided[1] in seed.NEVER_LAST:
        t = elided[1]
    head, _, tail = t.rpartition(".")
    if len(head.rsplit(".")[-1]) > 2 and head[-1:].isalpha():
        t = tail  # a sentence begins without a space before the abbreviation
    letters = t.replace(".", "")
    if t in seed.NEVER_LAST or t.split("/")[-1] in seed.NEVER_LAST:
        return "abbr"
    if len(letters) == 1 and token[-1:].isupper():
        return "initial"
    if t in seed.BEFORE_NUMBER:
        return "abbr" if kind in ("digit", "low", "other") or (len(t) == 1 and len(word) == 1) else ""
    if t in seed.MAYBE_LAST or (re.fullmatch(r"(?:[^\W\d_]\.)+[^\W\d_]", t) and t.isascii()):
        return "soft"
    if len(letters) == 1 and letters.isalpha():
        if not _cased(letters):
            return "abbr"
        if kind in ("digit", "low") or (len(word) == 1 and after == "."):
            return "abbr"
        return ""
    if re.search(r"[ऀ-ॿ]", t):
        return "abbr" if len(t) <= 4 else ""
    if re.search(r"[؀-ۿ]", t) and len(letters) <= 2:
        return "abbr"
    return ""


def _quote(s: str, a: int, e: int, start: int, heads: set[int]) -> tuple[int, int, tuple[str, ...]]:
    """Features of the place after a quotation from a to e that ends with a closing mark."""
    kind, j, word = _next(s, e, start, heads)
    if kind == "end":
        return e, start, ()
    feats = ["quote"]
    lead = unicodedata.normalize("NFC", s[max(0, a - 30) : a]).rstrip()
    said = re.search(r"[\w฀-๿]+$", lead)
    if lead and (lead[-1] in ",:：，،" or (said and said.group().lower() in seed.SPEECH)):
        feats.append("q_told")
        if kind in ("low",) or (kind == "bare" and re.match(r"[とっ]", s[start : start + 1] or " ")):
            feats.append("q_goes_on")
    elif kind in ("low", "other") or (kind == "open" and word in "—–(（"):
        feats.append("q_goes_on")
    elif kind == "bare" and re.match(r"[とっはがをにもの的]", s[start : start + 1]):
        feats.append("q_goes_on")
    elif kind in ("cap", "bare", "small") and _says(s, j):
        feats.append("q_goes_on")
    else:
        feats.append("q_alone")
    return e, start, tuple(feats)


#: Tags: inside a sentence, its boundary, quoted.
INSIDE, CUT, QUOTED = 0, 1, 2
#: Names of the weights of steps between tags. Among quoted places no step is weighed, so a quotation may be of any length.
STEPS = {(INSIDE, INSIDE): "in_in", (INSIDE, CUT): "in_cut", (CUT, INSIDE): "cut_in", (CUT, CUT): "cut_cut", (INSIDE, QUOTED): "to_quoted", (CUT, QUOTED): "to_quoted", (QUOTED, INSIDE): "from_quoted", (QUOTED, CUT): "from_quoted", (QUOTED, QUOTED): None}
NEVER = -1e9
#: Training: rounds over the seed lines (the weights of the second half are averaged), margin of the right tag, rate of steps.
ROUNDS, MARGIN, STEP = 120, 2.0, 0.1


def steps(tags: list[int], gaps: list[bool]) -> Iterator[str]:
    """Names of the weights of a block's steps, the first from inside; "empty" is a stretch of marks alone between two boundaries."""
    for a, b, g in zip([INSIDE, *tags], tags, gaps):
        if name := STEPS[a, b]:
            yield name
        if a == b == CUT and not g:
            yield "empty"


def score(feats: tuple[str, ...], kind: int, w: dict[str, float]) -> tuple[float, float, float]:
    """What a place says for each tag. In a quotation a mark may end a sentence of it or not, whichever it says; its end is quoted no more."""
    x = sum([w.get(f, 0.0) for f in feats])
    if kind == OPENS:
        return (-x, NEVER, x)
    return (-x, x if kind == MAY else NEVER, NEVER if "shut" in feats else abs(x))


def viterbi(scores: list[tuple[float, float, float]], gaps: list[bool], w: dict[str, float]) -> list[int]:
    """The best tags of a block's places. gaps: has the stretch before each place a letter or digit, or is it a quotation?

    The quoted tag begins only where a quotation can, at places that can be no boundary.
    """
    if not scores:
        return []
    step = {k: w.get(name, 0.0) if name else 0.0 for k, name in STEPS.items()}
    ii, ic, iq = step[0, 0], step[0, 1], step[0, 2]
    ci, cc, cq = step[1, 0], step[1, 1], step[1, 2]
    qi, qc = step[2, 0], step[2, 1]
    empty = cc + w.get("empty", 0.0)
    back = []
    inside, cut, quoted = 0.0, NEVER, NEVER
    for (a, b, c), g in zip(scores, gaps):
        from_in, from_cut = (inside + ii, 0), (cut + ci, 1)
        i = from_in if from_in[0] >= from_cut[0] else from_cut
        x, y = inside + ic, cut + (cc if g else empty)
        k = (x, 0) if x >= y else (y, 1)
        q = (NEVER, 0)
        if b < NEVER / 2:
            x, y = inside + iq, cut + cq
            q = (x, 0) if x >= y else (y, 1)
        if quoted > NEVER / 2:
            if quoted + qi > i[0]:
                i = (quoted + qi, 2)
            if quoted + qc > k[0]:
                k = (quoted + qc, 2)
            if quoted > q[0]:
                q = (quoted, 2)
        back.append((i[1], k[1], q[1]))
        inside, cut, quoted = i[0] + a, k[0] + b, q[0] + c
    last = max((inside, 0), (cut, -1), (quoted, -2))[1] * -1
    tags = [last]
    for b in reversed(back[1:]):
        last = b[last]
        tags.append(last)
    return tags[::-1]


def _chain(s: str) -> tuple[list[Place], list[bool]]:
    found = places(s)
    out, at = [], 0
    for e, start, feats, _ in found:
        # a quotation is a sentence even without a word
        out.append(s[at : at + 1].isalnum() and at < e or "quote" in feats or any(map(str.isalnum, s[at:e])))
        at = start
    return found, out


def _gold(found: list[Place], cuts: set[int]) -> list[int]:
    """The tags of labelled places: quoted from each start of a quotation to its end, else a boundary where a sentence ends."""
    out, quoted = [], False
    for e, _, feats, kind in found:
        quoted = (quoted or kind == OPENS) and "shut" not in feats
        out.append(QUOTED if quoted else CUT if kind == MAY and e in cuts else INSIDE)
    return out


@functools.lru_cache(maxsize=1)
def weights() -> tuple[tuple[str, float], ...]:
    """Averaged structured perceptron over the seed lines: decode, compare, correct."""
    blocks = []
    for text, cuts in seed.labelled():
        found, gaps = _chain(text)
        blocks.append((found, gaps, _gold(found, cuts)))
    w: dict[str, float] = defaultdict(float)
    total: dict[str, float] = defaultdict(float)
    for n in range(ROUNDS):
        for found, gaps, gold in blocks:
            # each right tag must win by a margin, which the wrong ones are given in training
            said = [score(x[2], x[3], w) for x in found]
            tags = viterbi([tuple(v + MARGIN * (k != right) for k, v in enumerate(x)) for x, right in zip(said, gold)], gaps, w)
            for x, tag, right in zip(found, tags, gold):
                if tag != right:
                    for f in x[2] if x[3] == OPENS or QUOTED not in (tag, right) else ():
                        w[f] += 1.0 if right > tag else -1.0
            # steps learn in small steps: what a place says comes first
            for path, part in ((gold, STEP), (tags, -STEP)):
                for name in steps(path, gaps):
                    w[name] += part
        if n >= ROUNDS // 2:
            for x, v in w.items():
                total[x] += v
    return tuple(sorted((x, v / (ROUNDS - ROUNDS // 2)) for x, v in total.items()))


def sentences(text: str, w: dict[str, float], known: dict | None = None) -> list[tuple[int, int]]:
    """(start, end) of the sentences of a text, in code points. known: scores by features, kept from text to text."""
    known = {} if known is None else known
    out = []
    at = 0
    blocks = []
    for m in BLANK.finditer(text):
        blocks.append((at, m.start()))
        at = m.end()
    blocks.append((at, len(text)))
    for a, b in blocks:
        s = text[a:b]
        if not s.strip():
            continue
        found, gaps = _chain(s)
        start = len(s) - len(s.lstrip())
        said = []
        for x in found:
            if (v := known.get(x[2:])) is None:
                v = known[x[2:]] = score(x[2], x[3], w)
            said.append(v)
        for (e, nxt, _, _), tag in zip(found, viterbi(said, gaps, w)):
            if tag == CUT and e > start:
                end = _trimmed(s, e)
                if end > start:
                    out.append((a + start, a + end))
                start = nxt
        end = len(s.rstrip())
        if end > start:
            start = min(end, start + len(s[start:]) - len(s[start:].lstrip()))
            out.append((a + start, a + end))
    return out


def cut_blocks(text: str, size: int) -> list[int]:
    """Starts of parts of a long text, each at a block's start and of at least size code points."""
    out, last = [0], 0
    for m in BLANK.finditer(text):
        if m.end() - last >= size and m.end() < len(text):
            out.append(m.end())
            last = m.end()
    return out


def found(documents: DataFrame, part: int = 65_536) -> DataFrame:
    """(doc_id, sent_start, sent_end), one row per sentence; null and blank texts have none.

    Scripts without marks: in Thai and Lao a space ends a sentence, in Khmer and
    Burmese where a block has none of their marks. A paragraph of any other script
    without marks is one sentence.

    Texts of more than part code points are cut before blocks and tagged in
    parts, several tasks to one text. Repeated rows come out as often as they
    are there. Columns other than doc_id and text are not looked at.
    """
    bound_batches(documents.sparkSession)
    learned = weights()

    @F.pandas_udf("array<struct<at:int,text:string>>")
    def cuts(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in parts:
            starts = [cut_blocks(t, part) for t in s]
            yield pd.Series([[{"at": a, "text": t[a:b]} for a, b in zip(c, [*c[1:], len(t)])] for t, c in zip(s, starts)], dtype=object)

    def tag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, known = dict(learned), {}
        for batch in batches:
            row, low, high = [], [], []
            for i, (at, text) in enumerate(zip(batch.column("at").to_pylist(), batch.column("text").to_pylist())):
                for x, y in sentences(text, w, known):
                    row.append(i)
                    low.append(at + x)
                    high.append(at + y)
            ids = batch.column("doc_id").take(pa.array(row, pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, pa.array(low, pa.int32()), pa.array(high, pa.int32())], ["doc_id", "sent_start", "sent_end"])

    rows = documents.where(F.col("text").isNotNull()).select("doc_id", "text")
    is_long = F.char_length("text") > 2 * part
    short = rows.where(~is_long).select("doc_id", F.lit(0).alias("at"), "text")
    long = rows.where(is_long).select("doc_id", F.inline(cuts("text"))).repartition("doc_id", "at")
    kind = T.StructType([T.StructField("doc_id", documents.schema["doc_id"].dataType), T.StructField("sent_start", T.IntegerType()), T.StructField("sent_end", T.IntegerType())])
    return short.unionByName(long).select("doc_id", "at", "text").mapInArrow(tag, kind)
