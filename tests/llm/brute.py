"""Plain Python versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from html.parser import HTMLParser

import numpy as np
import xxhash

WORD = re.compile("[^\x20\x09-\x0d]+")
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"


def words(text):
    return WORD.findall(text or "")


def quality_counts(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    found = words(text)
    lines = (text or "").split("\n")
    grams = [tuple(found[i : i + 5]) for i in range(len(found) - 4)]
    covered = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(5)}
    duplicates = sum(1 for i, line in enumerate(lines) if words(line) and line in lines[:i])
    return (
        len(found),
        sum(map(len, found)),
        sum((text or "").count(c) for c in "#*$%&|<>"),
        duplicates,
        len(covered),
    )


def lines_dropped(texts, min_docs=10):
    """n_lines, n_dropped and the text that stays, for each text."""

    def key(line):
        return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(SPACES))

    counts = Counter(k for t in texts for k in {key(x) for x in (t or "").split("\n")} if k)
    rows = []
    for t in texts:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not key(x) or counts[key(x)] < min_docs]
        rows.append((len(lines), len(lines) - len(kept), "\n".join(kept)))
    return rows


def fingerprint(text):
    found = [re.sub(b"[A-Z]", lambda m: m[0].lower(), w.encode()) for w in words(text)]
    if not found:
        return 0
    parts = [b" ".join(found[i : i + 3]) for i in range(len(found) - 2)] or [b" ".join(found)]
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(n, linked):
    """Group number of each of n items: the smallest item that links reach."""
    label = list(range(n))
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return label


def smallest(keys, label):
    least = {}
    for key, group in zip(keys, label):
        if key is not None:
            least[group] = min(least.get(group, key), key)
    return [least.get(group) for group in label]


def near_fingerprints(keys, texts, bits=3):
    prints = [fingerprint(t) for t in texts]
    pairs = [(a, b) for a in range(len(prints)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= bits]
    return prints, smallest(keys, groups(len(keys), pairs))


def one_of_each(keys, texts, bits=3):
    """The smallest key of each group of near fingerprints."""
    prints = [fingerprint(t) for t in texts]
    pairs = [(a, b) for a in range(len(prints)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= bits]
    label = groups(len(keys), pairs)
    return [smallest(keys, label)[group] for group in sorted(set(label))]


def near_vectors(keys, vectors, cosine=0.9):
    """Number of links and component of each vector."""

    def unit(v):
        if not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            return None
        v = np.array(v, float)
        return v / np.sqrt(v @ v)

    units = [unit(v) for v in vectors]
    pairs = [
        (a, b)
        for a in range(len(units))
        for b in range(a)
        if units[a] is not None and units[b] is not None and len(units[a]) == len(units[b]) and units[a] @ units[b] >= cosine
    ]
    links = Counter(x for pair in pairs for x in pair)
    return [links[i] for i in range(len(units))], smallest(keys, groups(len(keys), pairs))


def digest(spans):
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in spans).encode()).hexdigest()


def pii_spans(text):
    text = text or ""
    found = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        found.append(("email", m.start(), m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            found.append(("ip", m.start(), m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m[0] if c.isdigit()]
        total = sum(sum(divmod(2 * d, 10)) if i % 2 else d for i, d in enumerate(reversed(digits)))
        if 13 <= len(digits) <= 19 and total % 10 == 0:
            found.append(("card", m.start(), m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            found.append(("phone", m.start(), m.end()))
    return found


def secret_spans(text):
    text = text or ""
    letters = lambda w: "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w)
    names = "|".join(letters(w) for w in ("password", "passwd", "secret", "token", "api_?key"))
    found = [
        (m.start(), 0, ("assign", m.start(), m.end()))
        for m in re.finditer(rf"({names})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text)
        if len(m[2]) >= 6
    ]
    found += [(m.start(), 1, ("access", *m.span())) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, ("hex", *m.span())) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [span for _, _, span in sorted(found)]


class MainText(HTMLParser):
    """Text of article and main elements without the parts named as something else, by the standard library's parser."""

    BLOCKS = set("article aside blockquote body dd div dl dt footer form h1 h2 h3 h4 head header html li main nav ol p pre section table td tr ul".split())
    EMPTY = set("br hr img input link meta".split())
    OTHER = set("nav header footer aside form".split())
    NAMES = set("menu navbar sidebar ad ads advert banner promo cookie notice newsletter subscribe comments comment related share social".split())

    def __init__(self, html):
        super().__init__()
        self.stack, self.blocks, self.parts, self.hidden = [], [], [], 0
        self.feed(html)
        self.close()
        self.flush()

    def flush(self):
        text = " ".join("".join(self.parts).split())
        if text:
            self.blocks.append(text)
        self.parts = []

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style", "title"):
            self.hidden += 1
        if tag in self.BLOCKS:
            self.flush()
        if tag == "br":
            self.parts.append(" ")
        if tag in self.EMPTY:
            return
        if tag in self.BLOCKS and self.stack and self.stack[-1][0] == "p" or tag == "li" and self.stack and self.stack[-1][0] == "li":
            self.stack.pop()
        names = set(re.findall("[a-z]{2,}", " ".join(v or "" for k, v in attrs if k in ("class", "id", "role")).lower()))
        self.stack.append((tag, names))

    def handle_endtag(self, tag):
        if tag in ("script", "style", "title"):
            self.hidden = max(0, self.hidden - 1)
        if tag in self.BLOCKS:
            self.flush()
        if any(t == tag for t, _ in self.stack):
            while self.stack.pop()[0] != tag:
                pass

    def handle_data(self, data):
        inside = False
        for tag, names in self.stack:
            if tag in ("article", "main"):
                inside = True
            elif inside and (tag in self.OTHER or names & self.NAMES):
                return
        if inside and not self.hidden:
            self.parts.append(data)


def main_text(html):
    return "\n".join(MainText(html or "").blocks)
