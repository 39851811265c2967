"""Plain-Python results of the operators, for small tables."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

SPACE = " \t\n\x0b\x0c\r"


def low(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def line_dedup(rows: list[tuple]) -> list[tuple]:
    """(doc_id, kept text, n_lines, n_dropped) of (doc_id, text) rows."""
    lines = [(i, (t or "").split("\n")) for i, t in rows]
    holders = defaultdict(list)
    for i, own in lines:
        for key in {low(x.strip(SPACE)) for x in own}:
            if len(key) >= 20:
                holders[key].append(i)

    def stays(i, line):
        own = holders[low(line.strip(SPACE))]
        return len(own) < 3 or i == max((x for x in own if x is not None), default=None)

    out = []
    for i, own in lines:
        kept = [x for x in own if stays(i, x)]
        out.append((i, "\n".join(kept), len(own), len(own) - len(kept)))
    return out


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(text or ""))


def contamination(rows: list[tuple], items: list[tuple], window: int = 10) -> Counter:
    """(doc_id, n_words, n_hit, item ids) of (doc_id, text) rows."""
    held = defaultdict(set)
    for item, text in items:
        w = words(text)
        n = min(window, len(w))
        for a in range(len(w) - n + 1 if n else 0):
            held[tuple(w[a:a + n])].add(item)
    sizes = {len(x) for x in held}
    out = Counter()
    for i, text in rows:
        w, hit, ids = words(text), set(), set()
        for n in sizes:
            for a in range(len(w) - n + 1):
                if found := held.get(tuple(w[a:a + n])):
                    hit.update(range(a, a + n))
                    ids |= found
        out[i, len(w), len(hit), tuple(sorted(str(x) for x in ids if x is not None))] += 1
    return out


def rules(text: str | None) -> tuple:
    """n_words, word_chars, n_symbols, n_lines with a word, n_dup_lines, n_repeat_words."""
    text = text or ""
    w = re.findall("[^\x20\x09-\x0D]+", text)
    places = defaultdict(list)
    for a in range(len(w) - 7):
        places[tuple(w[a:a + 8])].append(a)
    repeated = {p for own in places.values() if len(own) > 1 for a in own for p in range(a, a + 8)}
    lines = [x for x in text.split("\n") if x.strip(SPACE)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines), len(lines) - len(set(lines)),
            len(repeated))
