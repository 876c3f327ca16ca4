"""Personal data by fixed patterns and a semi-Markov conditional random field.

Method: a text is segmented into entities of a kind (email, ip, card, phone) and single other characters.  The score of a
segmentation is the sum of its entities' scores, each a weighted sum of features of the whole span (digits and groups, their
lengths, separators, check digits, form of the at and dot signs, neighbouring characters).  Entities are bounded (``MOST_GROUPS``
groups of digits, ``MOST_LABELS`` labels of a domain, ``MOST_LOCAL`` characters before the at sign), so a text has few
candidates around each digit or at sign, and one dynamic program over them chooses boundaries and kinds together.  The same
recursion with sums in place of maxima gives the likelihood that the weights are learned from.

Learning: what the patterns find in a bounded sample of the texts are the labels; each sampled stretch is learned as it stands, with its
spans disguised (``disguised``: "name (at) mail dot com", other separators, no country code) and with numbers that are no personal
data in their places (``harmless``).  So the field finds spans that the patterns miss; spans of the patterns always stay.

Scale: documents are not shuffled; a text is searched in one pass over it, and the model is a few hundred numbers.
"""

from __future__ import annotations

import random
import re
import zlib
from bisect import bisect_right
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import received, send

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)
SAMPLE_TEXTS, SAMPLE_STRETCHES = 6000, 2000   # texts read for learning, stretches learned from
MOST_GROUPS, MOST_LABELS, MOST_LOCAL = 6, 8, 64
AROUND = 40                                   # characters kept on both sides of a sampled span
COST = 1.0                                    # an entity's score must exceed it
ROUNDS, PENALTY = 150, 0.1

# The patterns that always count, as the contract states them.
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9](?<![0-9][0-9])[0-9]*+\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LETTERS_LAST = re.compile(r"[A-Za-z]*\Z")
_DIGITS = re.compile(r"[0-9]+")

_DOT = r"(?:\.|\s?[\[({]\s?(?:dot|\.)\s?[\])}]\s?|\sdot\s|\s\.\s)"
_AT_PLAIN = re.compile("@")
_AT_BRACKETS = re.compile(r"[\[({]\s?(?:[aA][tT]|@)\s?[\])}]")
_LABELS = re.compile(rf"[A-Za-z0-9-]{{1,63}}(?:{_DOT}[A-Za-z0-9-]{{1,63}}){{1,{MOST_LABELS - 1}}}", re.IGNORECASE)
_DOT_SIGN = re.compile(_DOT, re.IGNORECASE)
_BEFORE = re.compile(rf"(?:[A-Za-z0-9_%+-]{{1,32}}{_DOT}){{0,2}}[A-Za-z0-9._%+-]{{1,{MOST_LOCAL}}}\Z", re.IGNORECASE)
_BETWEEN = rf"(?:[^\w\n]{{1,3}}|{_DOT})"
_STRETCH = re.compile(rf"[0-9]+(?:{_BETWEEN}[0-9]+)*+", re.IGNORECASE)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or 0) <= 255


def _emails(text: str) -> list[tuple]:
    """Leftmost matches of the email pattern: each at sign is tried once, with all that may stand before it."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and (text[start - 1].isascii() and text[start - 1].isalnum() or text[start - 1] in "._%+-"):
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            done = found.end()
            out.append((start, done, EMAIL))
        at = text.find("@", max(done, at + 1))
    return out


def base_spans(text: str) -> list[tuple]:
    """(start, end, kind) of the patterns' matches, by start and kind; per kind they are leftmost and do not overlap."""
    out = _emails(text) if "@" in text else []
    if _DIGITS.search(text):
        out += [(m.start(), m.end(), IP) for m in _IP.finditer(text) if all(_small(p) for p in m.group().split("."))]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 14:
                digits = m.group().replace(" ", "").replace("-", "")
                if 14 <= len(digits) <= 19 and luhn(digits):
                    out.append((m.start(), m.end(), CARD))
        if "+" in text:
            out += [(m.start(), m.end(), PHONE) for m in _PHONE.finditer(text) if 10 <= sum(c.isdigit() for c in m.group()) <= 15]
    return sorted(out, key=lambda s: (s[0], s[2]))


# --------------------------------------------------------------------------- candidates and their features

def _side(text: str, at: int) -> str:
    """Class of the character at a place."""
    if not 0 <= at < len(text):
        return "end"
    c = text[at]
    return "digit" if c.isdigit() else "letter" if c.isalpha() else "space" if c.isspace() else c if c in ".,-/:_@+#$%()[]=&*\"'" else "other"


def _sign(text: str) -> str:
    """Form of what stands between two parts."""
    t = text.strip().lower()
    if t in (".", "@", "-", "/", ""):
        return t + ("spaced" if len(text) > len(t) and t else "")
    return "word" if t in ("at", "dot") else "bracket" if t[0] in "[({" and t[-1] in "])}" else t


def _email_candidates(text: str):
    for at, after in _at_signs(text):
        tail = _LABELS.match(text, after)
        head = tail and _BEFORE.search(text, max(0, at - 140), at)
        if not head:
            continue
        at_form = _sign(text[at:after])
        starts = {head.start(): "all"}
        for m in _DOT_SIGN.finditer(text, head.start(), at):
            if len(m.group()) > 1:
                starts[m.end()] = "part"
        ends, last, forms = {}, after, []
        for m in _DOT_SIGN.finditer(text, after, tail.end()):
            forms.append(_sign(m.group()))
            last = _label_end(text, m.end(), tail.end())
            ends[last] = tuple(forms)
        whole = max(ends, default=None)
        for start, how in starts.items():
            inner = _sign_kinds(text, start, at)
            for end, dots in ends.items():
                top = len(_LETTERS_LAST.search(text, max(0, end - 8), end).group())
                yield start, end, EMAIL, [f"at{at_form}", f"form{at_form}/{'+'.join(sorted(set(dots)))}", f"top{min(top, 7)}",
                                          f"start{how}{inner}", f"end{end == whole}", f"left{_side(text, start - 1)}", f"right{_side(text, end)}"]


def _at_signs(text: str):
    """(start, end) of the forms of an at sign, with one white space on either side of those that are no words."""
    places = [(m.start(), m.end()) for m in _AT_PLAIN.finditer(text)] if "@" in text else []
    places += [(m.start(), m.end()) for m in _AT_BRACKETS.finditer(text)]
    places += [(m.start(), m.end()) for word in (" at ", " AT ") if word in text for m in re.finditer(word, text)]
    for start, end in sorted(places):
        if text[start] != " ":
            start -= start > 0 and text[start - 1].isspace()
            end += end < len(text) and text[end].isspace()
        yield start, end


def _label_end(text: str, at: int, end: int) -> int:
    while at < end and (text[at].isascii() and text[at].isalnum() or text[at] == "-"):
        at += 1
    return at


def _sign_kinds(text: str, start: int, end: int) -> str:
    kinds = {_sign(m.group()) for m in _DOT_SIGN.finditer(text, start, end)} - {"."}
    return "+".join(sorted(kinds))


def _digit_candidates(text: str):
    for run in _STRETCH.finditer(text):
        if run.end() - run.start() < 7:
            continue
        groups = []
        for g in _DIGITS.finditer(text, run.start(), run.end()):
            groups.append((g.start(), g.end()))
            if len(groups) > MOST_GROUPS + 1:
                groups.pop(0)
            yield from _ending_here(text, groups, run.start(), run.end())


def _ending_here(text: str, groups: list[tuple], first: int, last: int):
    """Candidates whose last group is the last of ``groups``."""
    end, digits, signs, lengths = groups[-1][1], "", [], []
    for k in range(len(groups) - 1, max(-1, len(groups) - 1 - MOST_GROUPS), -1):
        start = groups[k][0]
        digits = text[start:groups[k][1]] + digits
        lengths.insert(0, groups[k][1] - start)
        if k + 1 < len(groups):
            signs.insert(0, text[groups[k][1]:groups[k + 1][0]])
        n = len(digits)
        if n > 19:
            return
        if n < 4:
            continue
        kinds = []
        if len(lengths) == 4 and max(lengths) <= 3 and all("." in s or "dot" in s.lower() for s in signs):
            kinds.append(IP)
        if n >= 13:
            kinds.append(CARD)
        if 7 <= n <= 15:
            kinds.append(PHONE)
        if not kinds:
            continue
        begin = start
        while begin > 0 and text[begin - 1] in "(+" and start - begin < 2:
            begin -= 1
        forms = sorted({_sign(s) for s in signs})
        shape = ".".join(map(str, lengths))
        shared = [f"digits{n}", f"groups{len(lengths)}", f"signs{'|'.join(forms)}", f"shape{shape}", f"left{_side(text, begin - 1)}",
                  f"right{_side(text, end)}", f"more{start > first}{end < last}", f"mark{text[begin:start]}"]
        for kind in kinds:
            own = f"luhn{luhn(digits)}{digits[0]}" if kind == CARD else \
                f"small{all(_small(d) for d in re.split('[^0-9]+', text[start:end]) if d)}" if kind == IP else f"first{digits[:2] == '00'}{len(forms)}"
            yield begin, end, kind, [*shared, own]


def candidates(text: str):
    """(start, end, kind, features) of every candidate."""
    if _DIGITS.search(text):
        yield from _digit_candidates(text)
    yield from _email_candidates(text)


# --------------------------------------------------------------------------- the field

@dataclass
class Field:
    """Weights of the features of each kind; features that were not learned from weigh ``unknown``."""

    weights: dict
    unknown: float = -0.5

    def score(self, kind: int, features: list[str]) -> float:
        own = self.weights
        return sum([own.get((kind, f), self.unknown) for f in features]) + own.get((kind, ""), 0.0)


def best_segmentation(spans: list[tuple]) -> list[int]:
    """Numbers of the chosen spans among (start, end, score, ...), which come by end: they do not overlap and their scores' sum is largest."""
    ends = [s[1] for s in spans]
    best, before = [0.0], []
    for i, (start, _, score, *_) in enumerate(spans):
        p = bisect_right(ends, start, 0, i)
        before.append(p)
        best.append(max(best[-1], best[p] + score))
    out, i = [], len(spans)
    while i:
        if best[i] > best[i - 1]:
            out.append(i - 1)
            i = before[i - 1]
        else:
            i -= 1
    return out[::-1]


def added_spans(text: str, field: Field | None, base: list[tuple], cost: float = COST) -> list[tuple]:
    """(start, end, kind) that the field finds beside the patterns' spans, which it may not touch."""
    if field is None:
        return []
    free, taken = [], sorted((s, e) for s, e, _ in base)
    reach = []
    for _, e in taken:
        reach.append(max(e, reach[-1] if reach else 0))
    starts = [s for s, _ in taken]
    for start, end, kind, features in candidates(text):
        k = bisect_right(starts, end - 1)
        if k and reach[k - 1] > start:
            continue
        score = field.score(kind, features) - cost
        if score > 0:  # one that lowers the sum is never chosen
            free.append((start, end, score, kind))
    free.sort(key=lambda s: (s[1], s[0], s[3]))
    return [(free[i][0], free[i][1], free[i][3]) for i in best_segmentation(free)]


def learn_weights(examples: list[tuple], rounds: int = ROUNDS, penalty: float = PENALTY) -> Field | None:
    """Field of greatest penalised likelihood of the examples (text, gold spans)."""
    rows, names = [], {}
    for text, gold in examples:
        found, wanted = sorted(candidates(text), key=lambda c: (c[1], c[0], c[2])), {tuple(g) for g in gold}
        hits = [c[:3] in wanted for c in found]
        if found and sum(hits) == len(wanted):  # others have spans that are no candidates
            rows.append((found, hits))
    if not any(any(h) for _, h in rows):
        return None
    most = max(len(f) for f, _ in rows)
    places = max(len(c[3]) for f, _ in rows for c in f) + 1
    index = np.zeros((len(rows), most, places), np.int32)          # 0: no feature
    before = np.tile(np.arange(most), (len(rows), 1))
    gold, there = np.zeros((len(rows), most)), np.zeros((len(rows), most), bool)
    for r, (found, hits) in enumerate(rows):
        ends = [c[1] for c in found]
        for i, (start, _, kind, features) in enumerate(found):
            for j, f in enumerate([*features, ""]):
                index[r, i, j] = names.setdefault((kind, f), len(names) + 1)
            before[r, i] = bisect_right(ends, start, 0, i)
        gold[r, :len(found)], there[r, :len(found)] = hits, True
    w, first, second, each = np.zeros(len(names) + 1), np.zeros(len(names) + 1), np.zeros(len(names) + 1), np.arange(len(rows))
    for t in range(1, rounds + 1):
        score = np.where(there, w[index].sum(axis=2), -1e9)
        total = np.zeros((len(rows), most + 1))
        for i in range(most):
            total[:, i + 1] = np.logaddexp(total[:, i], total[each, before[:, i]] + score[:, i])
        mass, chance = np.zeros((len(rows), most + 1)), np.zeros((len(rows), most))
        mass[:, most] = 1.0
        for i in range(most - 1, -1, -1):
            taken = mass[:, i + 1] * np.exp(total[each, before[:, i]] + score[:, i] - total[:, i + 1])
            mass[:, i] += mass[:, i + 1] - taken
            np.add.at(mass, (each, before[:, i]), taken)
            chance[:, i] = taken
        gap = np.repeat((gold - chance)[:, :, None], places, axis=2)
        slope = np.bincount(index.ravel(), gap.ravel(), len(w)) - penalty * w
        slope[0] = 0.0
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope ** 2
        w = w + 0.2 * (first / (1 - 0.9 ** t)) / (np.sqrt(second / (1 - 0.99 ** t)) + 1e-8)
    return Field({name: float(w[i]) for name, i in names.items()})


# --------------------------------------------------------------------------- examples

def _replaced(text: str, spans: list[tuple], make) -> tuple[str, list[tuple]]:
    """The text with each span rewritten by ``make`` to (text, start, end of the entity in it: equal for none), and the entities.

    Of spans that overlap only the first is rewritten.
    """
    out, gold, length, at = [], [], 0, 0
    for start, end, kind in spans:
        if start >= at:
            new, lo, hi = make(text[start:end], kind)
            length += start - at
            if hi > lo:
                gold.append((length + lo, length + hi, kind))
            out += [text[at:start], new]
            length, at = length + len(new), end
    return "".join([*out, text[at:]]), gold


def crowded(span: str, kind: int, rnd: random.Random) -> tuple[str, int, int]:
    """A card or phone number beside another number, which patterns take for one; others stay alone."""
    if kind not in (CARD, PHONE):
        return span, 0, len(span)
    more = "".join(rnd.choice("0123456789") for _ in range(rnd.randint(7, 9)))
    if kind == CARD and rnd.random() < 0.5:
        return f"{more} {span}", len(more) + 1, len(more) + 1 + len(span)
    return f"{span} {more}", 0, len(span)


def disguised(span: str, kind: int, rnd: random.Random) -> str:
    """A span as people write it where patterns should not see it."""
    if kind == EMAIL:
        local, _, domain = span.rpartition("@")
        at = rnd.choice([" at ", " (at) ", "(at)", " [at] ", "[at]", " @ "])
        dot = rnd.choice([" dot ", " (dot) ", "(dot)", "[dot]", " [dot] ", "[.]", " . ", "."])
        if at == " at " and dot == ".":
            dot = " dot "
        return local + at + domain.replace(".", dot)
    if kind == IP:
        return span.replace(".", rnd.choice(["[.]", "(.)", " . ", " dot ", "(dot)", "[dot]"]))
    if kind == CARD:
        digits = re.sub("[^0-9]", "", span)
        sign = rnd.choice([".", "/", " ", "–", "  ", " - ", " . "])
        return sign.join(digits[i:i + 4] for i in range(0, len(digits), 4))
    digits = re.sub("[^0-9]", "", span)
    a, b, c = digits[-10:-7], digits[-7:-4], digits[-4:]
    return rnd.choice([f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"00{digits[:-10] or '1'} {a} {b} {c}", f"00{digits[:-10] or '1'}-{a}-{b}-{c}", f"({a}) {b} {c}"])


def harmless(kind: int, rnd: random.Random) -> str:
    """A number or phrase that is no personal data and stands where a span stood."""
    n = lambda k: "".join(rnd.choice("0123456789") for _ in range(k))
    date = (f"{rnd.randint(1900, 2030)}", f"{rnd.randint(1, 12):02d}", f"{rnd.randint(1, 28):02d}")
    time = f"{rnd.randint(0, 23):02d}:{n(2)}:{n(2)}"
    if kind == EMAIL:
        word = lambda: "".join(rnd.choice("aeionrstl") for _ in range(rnd.randint(2, 8)))
        return rnd.choice([f"{word()} at {word()}.{word().title()}", f"@{word()}", f"{word()} at {word()}", f"{word()}@{word()}",
                           f"{word()} @ {word()}", f"{word()} at the dot {word()}", f"{word()} at {word()}.com"])
    if kind == IP:
        return rnd.choice([f"{n(1)}.{n(2)}.{n(2)}", f"3{n(2)}.4{n(2)}.5{n(2)}.6{n(2)}", f"v{n(1)}.{n(1)}.{n(2)}", f"{n(3)}.{n(2)}", f"{n(2)} . {n(2)} . {n(2)}"])
    if kind == CARD:
        bad = next(d for d in iter(lambda: n(rnd.randint(13, 19)), None) if not luhn(d))
        sign = rnd.choice([".", "/", " ", "-", "", "  ", ", "])
        return rnd.choice([sign.join(bad[i:i + 4] for i in range(0, len(bad), 4)), bad, f"{n(3)}-{n(1)}-{n(2)}-{n(6)}-{n(1)}",
                           " ".join(date) + " " + time, "-".join(date) + " " + time + "." + n(3)])
    return rnd.choice([f"{n(rnd.randint(7, 12))}", "-".join(date), "/".join(date[::-1]), ".".join(date[::-1]), f"{'-'.join(date)} {time}", f"{n(3)}.{n(4)}",
                       f"{date[0]}-{n(4)}", f"{n(1)},{n(3)},{n(3)}", f"{n(3)} {n(3)} {n(3)}", f"{n(2)}, {n(2)}, {n(2)}, {n(2)}", f"{n(3)}-{n(4)}",
                       f"{n(4)} {n(4)}", f"{n(5)}-{n(4)}", f"({n(4)}) {n(3)}", f"{n(1)}.{n(3)}.{n(3)}", f"{n(2)}:{n(2)}-{n(2)}:{n(2)}"])


def _unclear(text: str) -> bool:
    """Whether some candidate that the patterns left out passes its check: a label of none would be a guess."""
    return any("luhnTrue" in f[-1] or f[-1] == "smallTrue" for _, _, kind, f in candidates(text) if kind in (IP, CARD))


def examples_of(stretches: list[str]) -> list[tuple]:
    """Learning examples of sampled stretches: each as it stands, disguised, beside other numbers, and with harmless ones."""
    out = []
    for text in stretches:
        rnd = random.Random(zlib.crc32(text.encode()))
        spans = base_spans(text)

        def hide(span, kind):
            new = disguised(span, kind, rnd)  # noqa: B023
            return new, 0, len(new)

        makes = [lambda s, k: (s, 0, len(s)), hide, hide, lambda s, k: crowded(s, k, rnd), *[lambda s, k: (harmless(k, rnd), 0, 0)] * 2]  # noqa: B023
        if spans:
            out += [_replaced(text, spans, make) for make in makes]
        elif not _unclear(text):
            out.append((text, []))
    return out


def _stretches(batches):
    """Surroundings of the patterns' spans and of other candidates in texts, one span each."""
    for batch in batches:
        out = []
        for text in batch.column("text").to_pylist():
            spans = base_spans(text)
            places = [(s, e) for s, e, _ in spans] + [(m.start(), m.end()) for m in _STRETCH.finditer(text) if m.end() - m.start() >= 7][:8]
            for s, e in places:
                if e - s <= 4 * AROUND:
                    lo, hi = max(0, s - AROUND), min(len(text), e + AROUND)
                    for a, b, _ in spans:  # never cut through another span
                        lo, hi = (b if a < lo < b else lo), (a if a < hi < b else hi)
                    out.append(text[min(lo, s):max(hi, e)])
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["stretch"])


def learn(docs: DataFrame, texts: int = SAMPLE_TEXTS, stretches: int = SAMPLE_STRETCHES) -> Field | None:
    """A field learned from at most ``stretches`` surroundings of spans, out of about ``texts`` distinct texts of ``docs`` (text).

    None where nothing is found to learn from (empty tables, null texts); copies of a text count once.
    """
    rows = docs.select(F.col("text")).where("text IS NOT NULL")
    share = max(1, rows.count() // texts)
    some = rows.where(F.pmod(F.xxhash64("text"), F.lit(share)) == 0).distinct()
    found = some.mapInArrow(_stretches, "stretch string").distinct().orderBy(F.xxhash64("stretch"), "stretch").limit(stretches).collect()
    return learn_weights(examples_of([r.stretch for r in found]))


# --------------------------------------------------------------------------- documents

RESULT = "doc_id long, base array<struct<kind:int,start:long,end:long>>, added array<struct<kind:int,start:long,end:long>>, redacted string"


def _finding(sent, redact: bool):
    place = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        field = received(sent)
        for batch in batches:
            base, added, texts = [], [], []
            for text in batch.column("text").to_pylist():
                text = text or ""
                own = base_spans(text)
                more = added_spans(text, field, own)
                base.append([{"kind": k, "start": s, "end": e} for s, e, k in own])
                added.append([{"kind": k, "start": s, "end": e} for s, e, k in more])
                texts.append(_without(text, own + more) if redact else None)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(base, place), pa.array(added, place), pa.array(texts, pa.string())],
                                             ["doc_id", "base", "added", "redacted"])
    return run


def _without(text: str, spans: list[tuple]) -> str:
    """The text with each span replaced by its kind; of spans that overlap the first names the kind and all are covered."""
    out, at = [], 0
    for start, end, kind in sorted(spans):
        if start >= at:
            out += [text[at:start], f"<{KINDS[kind]}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def find_personal_data(docs: DataFrame, field: Field | None, redact: bool = False) -> DataFrame:
    """doc_id, base, added, redacted of every row of ``docs`` (doc_id, text): the spans of the patterns, those the field adds, and the
    text without both (null unless asked for).

    A span is (kind: number in ``KINDS``, start, end) in code points, end exclusive; base spans come by start and kind and may overlap
    where their kinds differ, added ones overlap none.  Null texts are empty and have none; every row, repeated ones and null ids
    too, gets a row.  Without a field there are no added spans.  Other columns are not read.
    """
    sent = send(docs.sparkSession, field)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_finding(sent, redact), RESULT)
