"""Personal data: exact patterns, and a linear-chain conditional random field over word shapes that adds to them.

The field runs over stretches of words around marked ones: those that hold a digit of any script, an at sign, a plus or an
equals sign, that follow a name such as ``password:``, that are long or have capitals inside, or that spell an address out
(``at`` and ``dot``); by its definition all other words are outside. It is fitted from a small labelled table (``training_table`` makes one by rule; any
other may be given) and decoded by Viterbi, many stretches in step. Its spans never replace those of the patterns;
one that lies wholly within them is left out, any other is added beside them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinlink.llm.common import pieces, slices
from kinlink.llm.crf import Field, fit

KINDS = ["email", "ip", "card", "phone", "secret"]
BASE = KINDS[:4]
FEATURES = 1 << 16
#: Words before and after a word with a digit or sign that belong to its stretch.
REACH = 3
FOUND = T.StructType([
    T.StructField("kind", T.StringType()),
    T.StructField("start", T.IntegerType()),
    T.StructField("end", T.IntegerType()),
    T.StructField("base", T.BooleanType()),
])

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_SIGN = re.compile(r"[0-9@+=]")
_WORD = re.compile(r"\S+")
_MARKED = re.compile(r"(?<!\S)[^\s\d@+=]*+[\d@+=]\S*+")
#: A long word; whether it is marked is for ``_odd`` to say.
_LONG = re.compile(r"(?<!\S)\S{12,}+")
#: Names that announce a secret.
CUES = frozenset("password passwd passphrase passcode pwd pin secret token key apikey api_key secret_key access_key private_key credentials".split())
_CUE = re.compile(r"(?<!\S)[\"'(\[]{0,2}(?:[A-Za-z]{1,20}[_-]){0,3}(?:password|passwd|passphrase|passcode|pwd|pin|secret|token|key|apikey|credentials)[\"']?:(?!\S)", re.I)
_SPELLED = re.compile(r"(?<!\S)(?:[\[({]?dot[\])}]?)(?!\S)", re.I)


def luhn(digits: str) -> bool:
    """Whether the digits' check sum holds."""
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum((0, 2, 4, 6, 8, 1, 3, 5, 7, 9)[int(d)] for d in digits[-2::-2])) % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local part, at sign and dotted domain, found from the at signs: linear in the text."""
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (found := _DOMAIN.match(text, at + 1)):
            last = found.end()
            yield start, last
            at = text.find("@", last)
        else:
            last = max(last, at + 1)
            at = text.find("@", at + 1)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the four patterns, by start and then by kind; matches that fail their check are dropped, not retried."""
    if not _SIGN.search(text):
        return []
    found = [("email", *span) for span in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split(".")):
            found.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *m.span()))
    for m in _PHONE.finditer(text):
        if 9 <= sum(c in "0123456789" for c in m.group()) <= 15:
            found.append(("phone", *m.span()))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def word_shape(word: str) -> str:
    """Runs of capitals, letters and digits as one A, a or 9; other characters as they are."""
    out = []
    for c in word:
        kind = "9" if c.isdigit() else "A" if c.isupper() else "a" if c.isalpha() else c
        if not out or out[-1] != kind:
            out.append(kind)
    return "".join(out[:24])


_EDGES = "\"'()[]{}<>.,;:!?"


def _turns(core: str) -> int:
    """How often a capital stands behind a small letter."""
    return sum(a.islower() and b.isupper() for a, b in zip(core, core[1:]))


def _odd(core: str) -> bool:
    """Whether a word of letters alone may be a key: very long, or with capitals inside."""
    turns = _turns(core)
    return turns >= 3 or (len(core) >= 16 and turns > 0) or (len(core) >= 24 and core.isascii() and core.isalpha())


def _about(word: str) -> list[str]:
    core = word.strip(_EDGES)
    digits = sum(c.isdigit() for c in core)
    letters = sum(c.isalpha() for c in core)
    compact = core.replace("-", "").replace(" ", "")
    value = core.rpartition("=")[2].strip(_EDGES)
    own = [
        f"s:{word_shape(core)}",
        f"n:{min(len(core), 24) // 4}",
        f"d:{min(digits, 20)}",
        f"m:{digits > 0}{letters > 0}{core.isupper()}{min(len(core), 24) // 8}",
        f"w:{core.lower()}" if letters == len(core) else f"p:{core[:4]}" if letters else "",
        f"q:{word[:1] in _EDGES}{word[-1:] in _EDGES}{digits > 0}",
        f"h:{len(value) >= 16 and all(c in '0123456789abcdefABCDEF' for c in value)}{letters > 0}{min(len(value), 40) // 8}",
        f"k:{core.rpartition('=')[0].lower()}" if "=" in core else "",
        f"r:{digits * 3 >= len(core)}{len(core) >= 12}{'=' in core}{'@' in core}",
        f"c:{compact.isdigit() and 12 <= len(compact) <= 19 and compact.isascii() and luhn(compact)}{min(digits, 20)}",
        f"u:{core.lower() in CUES or re.split('[_-]', core.lower())[-1] in CUES}{word[-1:] if word[-1:] in ':=' else ''}",
        f"a:{core.lower()}" if core.lower() in ("at", "dot") else "",
        f"b:{word.lower()}" if word.lower() in ("[at]", "(at)", "[dot]", "(dot)", "{at}", "{dot}") else "",
        f"o:{min(_turns(core), 4)}{letters == len(core)}{min(len(core), 40) // 8}",
        f"t:{_turns(core) > 2}{_turns(core) * 5 >= len(core)}{letters == len(core)}" if _turns(core) else "",
        f"g:{core.count('-')}{[len(p) for p in core.split('-')][:5]}" if digits and "-" in core else "",
        f"i:{core.count(':')}{all(c in '0123456789abcdefABCDEF:' for c in core)}" if ":" in core else "",
        f"y:{word[:1]}{core.count(',')}{core.count('.')}" if digits and word[:1] in "$€£¥" else "",
        f"l:{len(core) in (7, 8, 10, 12, 13, 40, 64)}{len(core) if len(core) in (7, 40, 64) else ''}" if digits else "",
        f"v:{core.count('.')}{digits > 0}{letters > 0}{[len(p) for p in core.split('.')][:5]}",
    ]
    return [x for x in own if x]


def features(words: list[str]) -> list[list[int]]:
    """Hashed features of each word: its own, and shape and letters of the words beside it."""
    about = [_about(w) for w in words]
    out = []
    for i, own in enumerate(about):
        beside = [f"{step}{x}" for step in (-2, -1, 1) if 0 <= i + step < len(words) for x in about[i + step] if x[0] in "swduab"]
        spelled = [f"2{x}" for x in (about[i + 2] if i + 2 < len(words) else ()) if x[0] in "ab"]
        out.append([crc32(x.encode("utf-8", "surrogatepass")) % FEATURES for x in own + beside + spelled])
    return out


def training_table(rows: int = 3000, seed: int = 5) -> list[tuple[list[str], list[str]]]:
    """Labelled stretches made by rule: (words, label of each word), ``-`` for words that are not personal data."""
    rng = np.random.default_rng(seed)
    pick = lambda *choices: choices[rng.integers(len(choices))]
    number = lambda n: "".join(map(str, rng.integers(0, 10, n)))
    letters = lambda n, of="abcdefghijklmnopqrstuvwxyz": "".join(of[i] for i in rng.integers(0, len(of), n))
    capital = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

    def card() -> str:
        first = pick("4", "5", "37") + number(13)
        return next(first + str(c) for c in range(10) if luhn(first + str(c)))

    def plain() -> str:
        word = letters(rng.integers(1, 12))
        if rng.random() < 0.2:
            return pick("at", "and", "or", "the", "to", "in", "use", "call", "is", "from", "with", "on")
        return pick(word, word, word, word.title(), word.upper(), word + ".", word + ",", word + "é", word + "&&&", word + "!!")

    def split_number(text: str) -> list[str]:
        return text.split(" ")

    def other_digits(text: str) -> str:
        zero = pick("٠", "०", "０")
        return "".join(chr(ord(zero) + int(c)) if c in "0123456789" else c for c in text)

    def private() -> tuple[list[str], str]:
        kind = KINDS[rng.integers(5)]
        if rng.random() < 0.3:
            return rarer(kind), kind
        if kind == "email":
            return [f"{letters(5)}{pick('', '.', '_')}{number(2)}@{letters(5)}{pick('.com', '.org', '.example.net')}"], kind
        if kind == "ip":
            return [".".join(str(x) for x in rng.integers(1, 256, 4))], kind
        if kind == "card":
            digits = card()
            return pick([digits], split_number(" ".join(digits[i : i + 4] for i in range(0, len(digits), 4)))), kind
        if kind == "phone":
            a, b, c = number(3), number(3), number(4)
            return split_number(pick(f"+1 ({a}) {b}-{c}", f"+{number(2)} {a} {b} {c}", f"({a}) {b}-{c}", f"+{number(11)}")), kind
        mixed_case = lambda n: letters(n, capital + "0123456789")
        secret = pick(
            ["AKIA" + mixed_case(16)],
            [pick("password=", "passwd=", "secret=", "api_key=", "token=") + letters(rng.integers(12, 32), "0123456789abcdef")],
            [pick("token", "secret", "password", "key"), "=", '"' + letters(rng.integers(24, 44), "0123456789abcdef") + '"'],
            [pick("ghp_", "sk_live_", "xoxb-") + letters(rng.integers(24, 36), "abcdefghijklmnopqrstuvwxyzABCDEF0123456789")],
        )
        return secret, kind

    def mixed_key(n: int) -> str:
        return letters(n, capital + capital.lower())

    def rarer(kind: str) -> list[str]:
        """What the patterns cannot see. Words before a colon or an equals sign are no part of it."""
        a, b, c = number(3), number(3), number(4)
        if kind == "email":
            at, dot = pick(("at", "dot"), ("at", "dot"), ("[at]", "[dot]"), ("(at)", "(dot)"))
            more = [dot, pick("co", "ac")] if rng.random() < 0.2 else []
            return [letters(rng.integers(3, 8)), at, letters(rng.integers(4, 9)), *more, dot, pick("com", "org", "net", "uk")]
        if kind == "ip":
            groups = [letters(rng.integers(1, 5), "0123456789abcdef") for _ in range(8)]
            return [pick(":".join(groups), ":".join(groups[:3]) + "::" + groups[3], "2001:db8::" + groups[4])]
        if kind == "card":
            digits = other_digits(card())
            return pick([digits], [digits[i : i + 4] for i in range(0, len(digits), 4)])
        if kind == "phone":
            return split_number(pick(f"{a}-{b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", other_digits(f"+{number(2)} {a} {b} {c}"), f"0{a}/{b}{c}"))
        word = letters(rng.integers(8, 26))
        name = pick("password", "Password", "passwd", "passphrase", "secret", "token", "pwd", "key", "api_key", "PIN", letters(3, capital) + "_SECRET", letters(4) + "_token")
        key = mixed_key(rng.integers(20, 44))
        return pick(
            [name + ":", pick(word, word.title(), key, word + number(2))],
            [name + ":", pick(word, key)],
            [name, "=", pick("'", '"', "") + pick(word, key)],
            [name + "=" + pick(word, key)],
            [key],
            [key],
            [f"{number(3)}-{number(2)}-{number(4)}"],
        )

    def harmless() -> list[str]:
        hexes = "0123456789abcdef"
        digits = number(rng.integers(12, 20))
        digits = digits if not luhn(digits) else digits[:-1] + str((int(digits[-1]) + 1) % 10)
        if rng.random() < 0.4:
            common = ["required", "correct", "the", "this", "lost", "see", "an", "to", "reset", "wrong", "safe", "new"]
            isbn = f"{pick('978', '979')}-{number(1)}-{number(2)}-{number(6)}-{number(1)}"
            long_word = letters(rng.integers(12, 40))
            # a word of several names, as in code or a brand
            names = "".join(letters(rng.integers(3, 8)).title() for _ in range(rng.integers(2, 6)))
            return pick(
                [pick("$", "€", "£") + f"{rng.integers(1, 900)},{number(3)}" + pick("", ".00", f".{number(2)}")],
                [f"{rng.integers(1, 900)},{number(3)}{pick('', '.' + number(2))}", pick("USD", "EUR", "dollars", "people")],
                ["ISBN" + pick("", ":", "-13:"), pick(isbn, "978" + number(10), number(9) + pick("X", number(1)))],
                [pick("commit", "revision", "rev", "sha", "Commit", "commit:"), letters(pick(40, 40, 7, 8, 12), hexes)],
                [pick("sha256", "sha256:", "checksum", "checksum:", "digest", "md5"), letters(pick(64, 32), hexes)],
                [f"{rng.integers(10, 24)}:{rng.integers(10, 60)}:{rng.integers(10, 60)}"],
                [pick(long_word, long_word + "-" + letters(6))],
                [long_word.title()],
                [names],
                ["the", pick("password", "key", "token", "secret", "PIN"), pick("is", "to", "of", "was", "for"), pick(*common)],
                pick([digits], [digits], [digits[i : i + 4] for i in range(0, len(digits), 4)]),
                [pick("key", "secret", "token") + ":", pick(*common), letters(5), letters(4)],
                [pick("meet", "look", "was", "arrive"), "at", letters(5), pick("and", "the", "in"), letters(4)],
                ["a", "dot", "on", "the", letters(4)],
                [letters(5), "at", "the", "dot", letters(5)],
                ["https://" + letters(8) + ".org/" + letters(6) + "/" + letters(14)],
                [letters(6) + "/" + letters(6) + "/" + letters(6)],
                [pick("___", "---", "===", "***") * int(rng.integers(4, 12))],
            )
        return pick(
            [f"{rng.integers(0, 10)}.{rng.integers(0, 10)}."],
            ["version", f"{rng.integers(1, 20)}.{rng.integers(0, 20)}.{rng.integers(0, 20)}"],
            [str(rng.integers(1, 3000))],
            [str(rng.integers(1, 3000)) + pick(".", ",", "%")],
            [f"{rng.integers(1900, 2040)}-{rng.integers(10, 13)}-{rng.integers(10, 29)}"],
            [f"{rng.integers(10, 24)}:{rng.integers(10, 60)}"],
            [f"${rng.integers(1, 900)}.{rng.integers(10, 99)}"],
            [letters(1, capital) + number(1) + letters(1, capital)],
            [letters(4, capital) + "-" + number(2)],
            [letters(4) + number(2)],
            ["page=" + number(1)],
            [pick("page", "of", "No", "year", "chapter"), str(rng.integers(1, 3000)), "of", str(rng.integers(1, 3000))],
            [number(pick(1, 2, 3, 4, 5))],
            [letters(1), "=", str(rng.integers(1, 99))],
            [letters(1) + "=" + letters(1) + "+" + number(1)],
            ["C++"],
            ["@" + letters(6)],
            [f"https://{letters(7)}.example.com/{letters(4)}/{number(4)}?id={number(3)}"],
            ["isbn", number(10)],
            [number(pick(6, 7, 8, 9, 10, 20, 24))],
            [digits],
            ["licensed", "under", "CC", "BY-NC", "4.0."],
            [f"{letters(4)}/{number(2)}"],
        )

    table = []
    for _ in range(rows):
        words, labels = [], []
        for _ in range(rng.integers(1, 4)):
            for _ in range(rng.integers(0, 5)):
                words, labels = words + [plain()], labels + ["-"]
            if rng.random() < 0.45:
                more, kind = private()
                more = [*more[:-1], more[-1] + pick("", "", "", ".", ",")]
                # of a name, an equals sign and a value only the value is private
                named = more[0].endswith(":") and len(more) == 2
                own = ["-", "-", kind] if "=" in more[1:2] else ["-", kind] if named else [kind] * len(more)
            else:
                more = harmless()
                own = ["-"] * len(more)
            words, labels = words + more, labels + own
            if rng.random() < 0.15:
                words, labels = [*words, pick("at", "at", "or", "from", "dot")], [*labels, "-"]
            after = [plain()] if rng.random() < 0.8 else []
            words, labels = words + after, labels + ["-"] * len(after)
        table.append((words, labels))
    return table


def fit_field(table: list[tuple[list[str], list[str]]] | None = None) -> Field:
    """The field fitted from a labelled table."""
    labels = ["-", *KINDS]
    rows = training_table() if table is None else table
    return fit(labels, FEATURES, [(features(w), [labels.index(y) for y in ys]) for w, ys in rows if w])


def _marked(text: str) -> list[tuple[int, int]]:
    """Places of the marked words, in order."""
    places = {m.span() for m in _MARKED.finditer(text)}
    places |= {m.span() for pattern in (_CUE, _SPELLED) for m in pattern.finditer(text)}
    places |= {m.span() for m in _LONG.finditer(text) if _odd(m.group().strip(_EDGES))}
    return sorted(places)


def _stretches(text: str) -> list[list[tuple[int, int]]]:
    """Places of the words around marked ones, overlapping stretches as one."""
    out: list[list[tuple[int, int]]] = []
    for begin, stop in _marked(text):
        before, at = [], begin
        known = out[-1][-1][1] if out else 0
        while len(before) < REACH and at > known:
            end = at
            while end > known and text[end - 1].isspace():
                end -= 1
            start = end
            while start > known and not text[start - 1].isspace():
                start -= 1
            if start == end:
                break
            before.append((start, end))
            at = start
        gap = text[known:at].strip() if out else "x"
        here = [*before[::-1], (begin, stop)]
        if out and out[-1][-1][1] >= stop:
            continue  # already within reach of the one before
        if out and not gap:
            out[-1] += here
        else:
            out.append(here)
    for i, words in enumerate(out):
        stop = out[i + 1][0][0] if i + 1 < len(out) else len(text)
        at = words[-1][1]
        for _ in range(REACH):
            found = _WORD.search(text, at, stop)
            if not found:
                break
            words.append(found.span())
            at = found.end()
    return out


def _within(start: int, end: int, spans: list[tuple[int, int]]) -> bool:
    """Whether ``spans``, by start, together cover the place."""
    for s, e in spans:
        if s <= start:
            start = max(start, e)
    return start >= end


def find_all(texts: list[str], field: Field) -> list[list[tuple[str, int, int, bool]]]:
    """All spans (kind, start, end, whether of a pattern) of each text, by start and then by kind."""
    results, owners, places, rows, flat, lengths = [], [], [], [], [], []
    for i, text in enumerate(texts):
        results.append([(*s, True) for s in base_spans(text)])
        for words in _stretches(text):
            for own in features([text[a:b] for a, b in words]):
                rows += [len(places)] * len(own)
                flat += own
                places.append(None)
            places[-len(words) :] = words
            owners.append(i)
            lengths.append(len(words))
    if not lengths:
        return results
    scores = field.emissions(np.array(rows), np.array(flat), len(places))
    labels = field.decode(scores, np.array(lengths))
    at = 0
    for owner, n in zip(owners, lengths):
        text, begin = texts[owner], at
        at += n
        base = [(s, e) for _, s, e, of_pattern in results[owner] if of_pattern]
        i = begin
        while i < at:
            j = i + 1
            while j < at and labels[j] == labels[i]:
                j += 1
            if labels[i]:
                start, end = places[i][0], places[j - 1][1]
                while start < end and text[start] in _EDGES and text[start] != "(":
                    start += 1
                while start < end and text[end - 1] in _EDGES:
                    end -= 1
                if start < end and not _within(start, end, base):
                    results[owner].append((field.labels[labels[i]], start, end, False))
            i = j
    return [sorted(r, key=lambda s: (s[1], KINDS.index(s[0]), s[2])) for r in results]


def load(spark: SparkSession, table: list[tuple[list[str], list[str]]] | None = None):
    """The fitted field as a broadcast of fixed size."""
    return spark.sparkContext.broadcast(fit_field(table))


def spans(text: str | Column, field) -> Column:
    """Array of (kind, start, end, base) in code points, end exclusive. Null and empty texts have none."""

    @F.arrow_udf(T.ArrayType(FOUND))
    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]))
        for batch in batches:
            rows = []
            for run in slices((t or "" for t in pieces(batch)), 2_000_000):
                for found in find_all(run, field.value):
                    rows.append([dict(zip(("kind", "start", "end", "base"), s)) for s in found])
            yield pa.array(rows, kind)

    return find(text)


def listed(found: str, base_only: bool = False) -> Column:
    """The spans of an array as ``kind:start:end``, joined by commas."""
    chosen = F.filter(found, lambda s: s["base"]) if base_only else F.col(found)
    return F.array_join(F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def masked(text: str | Column, field) -> Column:
    """Texts with each span, overlapping ones as one, replaced by its (first) kind in angle brackets; null stays null."""

    @F.arrow_udf(T.StringType())
    def mask(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            out = []
            for run in slices((t or "" for t in pieces(batch)), 2_000_000):
                for whole, found in zip(run, find_all(run, field.value)):
                    parts, at = [], 0
                    for kind, start, end, _ in found:
                        if start >= at:
                            parts += [whole[at:start], f"<{kind.upper()}>"]
                        at = max(at, end)
                    out.append("".join(parts) + whole[at:])
            yield pa.array([o if v else None for o, v in zip(out, batch.is_valid().to_pylist())], pa.string())

    return mask(text)


def find_in_table(df: DataFrame, field, text: str = "text", into: str = "pii") -> DataFrame:
    """``df`` with a column of spans (one of that name is replaced)."""
    return df.withColumn(into, spans(F.col(f"`{text}`"), field))


def digest(found: Column) -> Column:
    return F.sha2(found.cast("binary"), 256)

