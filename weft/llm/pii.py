"""Operator 5: personal data. Base patterns always count; boosted trees decide about looser candidates.

Generators with high recall propose spans, overlapping ones too: the base patterns of each kind, and looser forms
(addresses with "[at]" and "[dot]", numbers grouped in other ways, addresses with bracketed dots). Candidates that
are no base match are described by their format and the words beside them; the trees of their kind score them, and a
span is added if its score reaches the kind's threshold and it touches neither a base span nor a better candidate. No
text here is labelled for personal data, so trees and thresholds come from examples drawn from a seeded generator: two
thirds to fit, one third to set each threshold to the lowest score at which no more than 1 in 100 chosen ones is wrong.
"""

from __future__ import annotations

import random
import re
from functools import cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weft.llm.gbt import Trees, fit

KINDS = ("email", "ip", "card", "phone")
#: Characters beside a candidate in which cue words are looked for.
CONTEXT = 32

# The base patterns. Local parts are found backwards from "@", which gives the same leftmost matches.
AT = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]*\Z")
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

# Looser candidates.
LOOSE_EMAIL = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}\s?(?:\[at\]|\(at\)|\{at\}|@)\s?[A-Za-z0-9-]{1,63}(?:\s?(?:\.|\[dot\]|\(dot\)|\{dot\})\s?[A-Za-z0-9-]{2,63}){1,4}")
LOOSE_IP = re.compile(r"(?<![0-9.])[0-9]{1,3}(?:\[\.\]|\(\.\)|\.)[0-9]{1,3}(?:\[\.\]|\(\.\)|\.)[0-9]{1,3}(?:\[\.\]|\(\.\)|\.)[0-9]{1,3}(?![0-9])")
LOOSE_NUMBER = re.compile(r"(?<![0-9+(])[(]?[0-9](?:[ ().\-/]{0,2}[0-9]){6,18}(?![0-9])")

CUES = {
    "email": ("mail", "contact", "write", "reach", "address", "@"),
    "ip": ("ip", "host", "server", "address", "ping", "login"),
    "card": ("card", "visa", "master", "credit", "debit", "payment", "expires"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "whatsapp", "dial"),
}
AGAINST = ("version", "isbn", "order", "date", "ref", "invoice", "total", "page", "section", "serial", "build", "id")
Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches of each kind that pass its test, by kind and start; code points, end exclusive."""
    out: list[Span] = []
    if "@" in text:
        last = 0
        for m in AT.finditer(text):
            a = at = m.start()
            while a > last and text[a - 1] in LOCAL_CHARS:
                a -= 1
            if a < at:
                out.append(("email", a, m.end()))
                last = m.end()
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum(map(str.isdigit, m[0])) <= 15:
                out.append(("phone", m.start(), m.end()))
    return out


def candidates(text: str) -> list[Span]:
    """Looser spans of each kind, overlapping ones too."""
    out = []
    if "at]" in text or "at)" in text or "at}" in text or "@" in text:
        out += [("email", m.start(), m.end()) for m in LOOSE_EMAIL.finditer(text)]
    if ".]" in text or ".)" in text:
        out += [("ip", m.start(), m.end()) for m in LOOSE_IP.finditer(text)]
    for m in LOOSE_NUMBER.finditer(text):
        n = sum(map(str.isdigit, m[0]))
        if 13 <= n <= 19:
            out.append(("card", m.start(), m.end()))
        if 7 <= n <= 15:
            out.append(("phone", m.start(), m.end()))
    return out


def describe(text: str, span: Span) -> list[float]:
    """Format and context of a candidate as numbers."""
    kind, a, b = span
    s, before, after = text[a:b], text[max(0, a - CONTEXT) : a].lower(), text[b : b + CONTEXT].lower()
    digits = "".join(c for c in s if "0" <= c <= "9")
    groups = [len(x) for x in re.findall(r"[0-9]+", s)] or [0]
    return [
        float(len(s)),
        float(len(digits)),
        float(len(groups)),
        float(max(groups)),
        float(min(groups)),
        float(groups[-1]),
        float(len(set(groups))),
        float(len(set(digits))),
        float(s.count(" ")),
        float(s.count("-")),
        float(s.count(".")),
        float(s.count("/")),
        float("(" in s),
        float(s.startswith("00")),
        float(luhn(digits)) if digits else 0.0,
        float(int(digits[:4] or 0)),
        float("at" in s and "@" not in s),
        float("dot" in s or "[.]" in s or "(.)" in s),
        float(s[-1:].isalpha()),
        float(any(c in before for c in CUES[kind])),
        float(any(c in after for c in CUES[kind])),
        float(any(re.search(rf"\b{c}\b", before) for c in AGAINST)),
        float(before[-1:].isalnum()),
        float(after[:1].isalnum()),
        float(before[-1:] in "$€£#"  and before != ""),
    ]


def example(rng: random.Random, kind: str, good: bool) -> tuple[str, Span]:
    """One drawn text with a candidate of the kind in it."""
    d = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    w = lambda: "".join(rng.choice("abcdefghijklmnoprstuvw") for _ in range(rng.randint(2, 9)))
    words = lambda k: " ".join(w() for _ in range(k))
    cue = rng.choice(CUES[kind][:-1]) + rng.choice([": ", " ", " at ", " is "])
    wrong = rng.choice([*AGAINST, w(), w(), "the"]) + rng.choice([" ", ": ", " no. "])
    lead = cue if good else wrong
    if kind == "email":
        at, dot = (rng.choice(["[at]", "(at)", "{at}"]), rng.choice(["[dot]", "(dot)", "."])) if good else (rng.choice(["(at)", "@ ", " @"]), rng.choice([".", ". "]))
        gap = rng.choice(["", " "])
        s = f"{w()}{gap}{at}{gap}{w()}{gap if dot != '.' else ''}{dot}{gap if dot != '.' else ''}{rng.choice(['com', 'org', 'net', 'de']) if good else w()}"
        lead = cue if good and rng.random() < 0.7 else words(2) + " "
    elif kind == "ip":
        parts = [str(rng.randint(0, 255) if good else rng.choice([rng.randint(0, 12), rng.randint(256, 999)])) for _ in range(4)]
        s = rng.choice(["[.]", "(.)"] if good else ["[.]", "."]).join(parts)
    elif kind == "card":
        n = 16
        body = rng.choice("3456") + d(n - 2)
        check = next(c for c in "0123456789" if luhn(body + c))
        body += check if good else rng.choice([c for c in "0123456789" if c != check])
        sep = rng.choice([".", "/", "  "] if good else ["", " ", "-", "."])
        s = sep.join(body[k : k + 4] for k in range(0, n, 4))
    elif good:
        s = rng.choice([f"({d(3)}) {d(3)}-{d(4)}", f"{d(3)}-{d(3)}-{d(4)}", f"{d(3)}.{d(3)}.{d(4)}", f"00{d(2)} {d(2)} {d(4)} {d(4)}", f"0{d(3)} {d(6)}", f"0{d(3)}/{d(7)}"])
    else:
        s = rng.choice([f"{rng.randint(1900, 2100)}-{rng.randint(10, 12)}-{rng.randint(10, 28)}", d(rng.randint(7, 15)), f"{d(1)}.{d(2)}.{d(4)}", f"{d(3)} {d(3)} {d(3)}", f"{d(4)} {d(4)} {d(4)} {d(4)}"[: rng.randint(9, 18)].strip(), f"({d(3)}) {d(3)}-{d(4)}", f"{d(3)}-{d(3)}-{d(4)}"])
    text = f"{words(rng.randint(0, 4))} {lead}{s}{rng.choice([' ', '. ', ', '])}{words(rng.randint(1, 4))}"
    a = text.index(lead + s) + len(lead)
    return text, (kind, a, a + len(s))


@cache
def models(draws: int = 3000, wrong_share: float = 0.01) -> dict[str, tuple[Trees, float]]:
    """Trees and threshold of each kind, from so many drawn examples."""
    out = {}
    for kind in KINDS:
        rng = random.Random(f"pii:{kind}")
        y = np.array([float(rng.random() < 0.5) for _ in range(draws)])
        x = np.array([describe(*example(rng, kind, bool(v))) for v in y])
        cut = draws * 2 // 3
        trees = fit(x[:cut], y[:cut], trees=40, depth=3)
        p, z = trees.probability(x[cut:]), y[cut:]
        order = np.argsort(-p)
        wrong = np.cumsum(1 - z[order]) / np.arange(1, len(order) + 1)
        fine = np.flatnonzero(wrong <= wrong_share)
        out[kind] = trees, max(0.9, float(p[order][fine[-1]])) if len(fine) else 2.0
    return out


def find(text: str, fitted: dict[str, tuple[Trees, float]]) -> tuple[list[Span], list[Span]]:
    """(base spans, added spans) of a whole text, each by kind and start."""
    base = base_spans(text)
    loose = candidates(text)
    if not loose:
        return base, []
    taken = [(a, b) for _, a, b in base]
    loose = [c for c in loose if not any(c[1] < b and a < c[2] for a, b in taken)]
    scored = []
    for kind in KINDS:
        own = [c for c in loose if c[0] == kind]
        if own:
            trees, least = fitted[kind]
            p = trees.probability(np.array([describe(text, c) for c in own]))
            scored += [(-v, c) for v, c in zip(p.tolist(), own, strict=True) if v >= least]
    added: list[Span] = []
    for _, c in sorted(scored):
        if not any(c[1] < b and a < c[2] for _, a, b in added):
            added.append(c)
    return base, sorted(added, key=lambda c: (KINDS.index(c[0]), c[1]))


def redact(text: str, spans: list[Span]) -> str:
    """The text with each span, or each union of overlapping ones, replaced by its first kind in brackets."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


SPANS = "array<struct<kind:string,start:int,end:int,added:boolean>>"


def detect_pii(docs: DataFrame, *, redacted: bool = False) -> DataFrame:
    """Per document: doc_id, spans (by kind and start, with whether they were added), and if asked the redacted text.

    Null texts count as empty and have no spans; null and repeated ids keep a row each; other columns aren't read; empty
    tables give no rows. Each text is worked on whole and alone, so nothing is shuffled.
    """
    fitted = models()
    text_field = ", redacted string" if redacted else ""

    def run(batches):
        import pyarrow as pa

        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("added", pa.bool_())]))
        for batch in batches:
            spans, texts = [], []
            for t in batch.column(1):
                t = t.as_py() or ""
                base, more = find(t, fitted)
                both = sorted([(*s, False) for s in base] + [(*s, True) for s in more], key=lambda s: (KINDS.index(s[0]), s[1]))
                spans.append([{"kind": k, "start": a, "end": b, "added": x} for k, a, b, x in both])
                if redacted:
                    texts.append(redact(t, base + more))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, kind), *([pa.array(texts, pa.string())] if redacted else [])], ["doc_id", "spans", *(["redacted"] if redacted else [])])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, f"doc_id long, spans {SPANS}{text_field}")
