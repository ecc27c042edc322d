"""Documents that hold the awkward cases, and brute-force versions of the operators."""

import collections
import random
import re

from pyspark.sql import types as T

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("n", T.StringType()),
        T.StructField("h", T.StringType()),
    ]
)


def prose(seed, words, lines=True):
    rng = random.Random(seed)
    syllables = "the an re in of tion ver ment and ou el ble sch ke it".split()
    out = []
    for i in range(words):
        word = "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))
        out.append(word + ("\n" if lines and i % 9 == 8 else " "))
    return "".join(out).strip()


def edited(text, seed, share):
    rng = random.Random(seed)
    return " ".join(f"new{rng.randrange(10**6)}" if rng.random() < share else w for w in text.split(" "))


def awkward_texts():
    base, long = prose(1, 120), prose(2, 6000)
    passage = prose(3, 90, lines=False)
    texts = [None, "", " \t\n ", "one", "a b c", "a b c d", "a b c d e", "A B C D E", base, base, base.upper()]
    texts += [edited(base, i, 0.02) for i in range(6)]
    texts += [prose(20, 60) + "\n" + passage, passage + "\n" + prose(21, 60), passage, long, long + " end", "é ñ ß 漢字 ▁x \x0b y"]
    texts += ["x" * 3000, "ab" * 900, "same line\n" * 300, "word " * 200, prose(5, 40) + "\n\n" + prose(6, 40)]
    texts += [f"{prose(40 + i, 50)}\nshared first line\nshared second line\nshared third line\nshared fourth line\n{prose(60 + i, 50)}" for i in range(5)]
    return texts


def awkward(spark, texts=None):
    texts = awkward_texts() if texts is None else texts
    return spark.createDataFrame([(i, t, None if i % 3 else "en", "c", None) for i, t in enumerate(texts)], SCHEMA)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def near_duplicates(texts):
    sets = [shingles(t) for t in texts]
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return [(i, len(s), root(i), root(i) == i) for i, s in enumerate(sets)]


def repeats(texts, size=400):
    data = [(t or "").encode() for t in texts]
    seen = collections.Counter(d[i : i + size] for d in data for i in range(len(d) - size + 1))
    out = []
    for d in data:
        covered = bytearray(len(d))
        for i in range(len(d) - size + 1):
            if seen[d[i : i + size]] > 1:
                covered[i : i + size] = b"\1" * size
        kept = bytes(b for b, c in zip(d, covered) if not c)
        spans = sum(1 for i, c in enumerate(covered) if c and (i == 0 or not covered[i - 1]))
        out.append((len(d), len(d) - len(kept), spans, kept))
    return out
