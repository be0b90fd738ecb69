"""Plain Python versions of the operators for small inputs."""

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(value) -> str:
    return hashlib.sha256(value if isinstance(value, bytes) else value.encode()).hexdigest()


def lower(text: str) -> str:
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def repeats(texts: list, length: int = 400) -> list[tuple]:
    """(n_bytes, n_removed, n_spans, kept_sha256) of each text."""
    data = [(t or "").encode() for t in texts]
    count = Counter(t[i : i + length] for t in data for i in range(len(t) - length + 1))
    out = []
    for t in data:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if count[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((len(t), sum(gone), spans, sha(kept)))
    return out


def passages(rows: list[tuple], size: int = 50) -> list[tuple]:
    """(n_words, n_removed, kept_sha256) of each (doc_id, text)."""
    last = 1 << 63
    words = [WORD.findall(t or "") for _, t in rows]
    ids = [last if d is None else d for d, _ in rows]
    low: dict = defaultdict(lambda: last)
    for d, w in zip(ids, words):
        for i in range(len(w) - size + 1):
            key = tuple(w[i : i + size])
            low[key] = min(low[key], d)
    out = []
    for d, w in zip(ids, words):
        gone = [False] * len(w)
        for i in range(len(w) - size + 1):
            if low[tuple(w[i : i + size])] < d:
                gone[i : i + size] = [True] * size
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((len(w), sum(gone), sha(kept)))
    return out


def shingle_set(text, size: int = 5) -> set:
    w = WORD.findall(lower(text))
    if not w:
        return set()
    return {tuple(w[i : i + size]) for i in range(max(len(w) - size + 1, 1))}


def groups(rows: list[tuple], percent: int = 75) -> list[tuple]:
    """(n_shingles, component_id) of each (doc_id, text), ids not null."""
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, x in enumerate(sets):
        for j in range(i):
            both = len(x & sets[j])
            if both and 100 * both >= percent * (len(x) + len(sets[j]) - both):
                a, b = root(i), root(j)
                parent[a] = b
    least: dict = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return [(len(x), least.get(root(i)) if x else rows[i][0]) for i, x in enumerate(sets)]


def counts(text) -> tuple:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)."""
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    marked = [False] * len(w)
    for i in range(len(w) - 7):
        if windows[tuple(w[i : i + 8])] > 1:
            marked[i : i + 8] = [True] * 8
    failed = len(w) < 20 or 100 * sum(marked) > 30 * len(w)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), sum(marked), failed)


#: Null, empty, white space, one word, ties and repeated rows, clashing ids.
LONG = " ".join(f"word{i % 97}x{i}" for i in range(30_000))
ODD = [
    (1, None), (2, ""), (3, " \n\t "), (4, "word"), (5, "word"), (5, "word"), (None, "no id at all"),
    (None, None), (6, "É" * 500), (7, LONG), (8, LONG), (9, "a " * 300), (10, "a\x00b c　d"),
]
