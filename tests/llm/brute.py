"""Plain statements of the operators' results, for small inputs."""

import hashlib
import re
from collections import Counter, defaultdict

from pyspark.sql.types import LongType, StringType, StructField, StructType

SCHEMA = StructType(
    [
        StructField("doc_id", LongType()),
        StructField("text", StringType()),
        StructField("lang", StringType()),
        StructField("source", StringType()),
        StructField("n_chars", LongType()),
    ]
)

LONG = " ".join(f"w{i * 7919 % 30011}" for i in range(20_000))
P = "the quick brown fox jumps over the lazy dog while seven wizards mix a strange green potion near the old mill "

#: NULLs in every column, empty and very long texts, ties and repeated rows.
ODD_ROWS = [
    (1, None, "en", "a", 0),
    (2, "", None, "a", None),
    (3, " \t\n ", "en", None, 3),
    (4, "one two three", "en", "b", 13),
    (4, "one two three", "en", "b", 13),
    (5, "one  two three ", "en", "b", 15),
    (6, "One two\x0bthree", "en", "c", 13),
    (None, "one two three", None, None, None),
    (None, P * 3, "en", "c", 300),
    (7, P * 3, "en", "c", 300),
    (8, P * 3 + "!", "en", "d", 301),
    (9, LONG, "en", "d", len(LONG)),
    (10, LONG + " end", "en", "a", len(LONG) + 4),
    (11, "é à ü ñ ß 日本語 🙂 é " * 40, "fr", "a", 900),
    (12, "spam $$$ ### " * 60, "en", "d", 780),
    (13, "x" * 5000, "en", "d", 5000),
]

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def spans_removed(rows, size):
    count = Counter()
    for _, text in rows:
        b = (text or "").encode()
        count.update(b[i : i + size] for i in range(len(b) - size + 1))
    out = []
    for doc_id, text in rows:
        b = (text or "").encode()
        gone = bytearray(len(b))
        done = 0
        for i in range(len(b) - size + 1):
            if count[b[i : i + size]] > 1:
                for k in range(max(i, done), i + size):
                    gone[k] = 1
                done = i + size
        spans = sum(1 for k in range(len(b)) if gone[k] and not (k and gone[k - 1]))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((doc_id, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def exact(rows):
    groups = defaultdict(list)
    norm = [re.sub(r"[\x20\x09-\x0D]", "", text or "") for _, text in rows]
    for (doc_id, text), key in zip(rows, norm):
        groups[key].append((-len(text or ""), doc_id is None, doc_id))
    out = []
    for (doc_id, text), key in zip(rows, norm):
        n, _, best = min(groups[key])
        out.append((doc_id, best, len(groups[key]), (doc_id, -len(text or "")) == (best, n), hashlib.sha256(key.encode()).hexdigest()))
    return sorted(out, key=str)


def gram_set(text, n):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = WORD.findall(lowered)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) or frozenset([tuple(words)])


def components(rows, n, percent):
    sets = [gram_set(text, n) for _, text in rows]
    top = list(range(len(rows)))

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                top[root(i)] = root(j)
    low = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            low[root(i)] = min(doc_id, low.get(root(i), doc_id))
    return sorted(
        ((d, len(sets[i]), low.get(root(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)), key=str
    )


def rule_counts(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    seen = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {k for i in range(len(words) - 7) if seen[tuple(words[i : i + 8])] > 1 for k in range(i, i + 8)}
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)
    )


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)
