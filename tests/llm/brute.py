"""Plain Python versions of what the operators compute, and a table of odd documents."""

import random
import re
from collections import Counter

import xxhash

BLANKS = re.compile("[^\x20\x09-\x0d]+")
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, fp long, _id string, _key string, "
          "part int, h long, item_id string, label int, spans string")


def odd_documents(spark, rows=()):
    """Null, empty, blank, repeated, very long and ordinary texts; null ids and languages; clashing extra columns."""
    rng = random.Random(3)
    vocabulary = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 9))) for _ in range(400)]

    def prose(n):
        return " ".join(rng.choices(vocabulary, k=n))

    base = prose(120)
    texts = [None, "", " \n\t ", "one", "two words", base, base, base.upper(), base + " more", base.replace(" ", "\n", 3),
             prose(60_000), prose(300) + "  wide　blanks éß中文 \U0001f600", "x" * 100_000,
             "same " * 200, "line\n" * 50, "tab\there  double  blanks \n \n end "]
    texts += [prose(rng.randint(1, 80)) for _ in range(30)] + list(rows)
    out = [(i + 1, t, ("en", "de", None)[i % 3], "hot" if i % 2 else None, len(t or ""), i, "a", "b", 1, 2, "c", 3, "d")
           for i, t in enumerate(texts)]
    out += [out[5], out[5], out[0], (None, base, "en", None, None, *out[0][5:]), (None, None, None, None, None, *out[0][5:]),
            (None, "no id at all here", None, None, None, *out[0][5:])]
    return spark.createDataFrame(out, SCHEMA), out


def empty_documents(spark):
    return spark.createDataFrame([], SCHEMA)


def fingerprint(text, k=4):
    words = BLANKS.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(items, near):
    """Least reachable index of every item."""
    root = list(range(len(items)))
    for i in range(len(items)):
        for j in range(i):
            if near(items[i], items[j]) and root[i] != root[j]:
                a, b = sorted((root[i], root[j]))
                root = [a if r == b else r for r in root]
    return root


def rule_counts(text):
    text = text or ""
    words = BLANKS.findall(text)
    seen = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    often = {p for i in range(len(words) - 7) if seen[tuple(words[i:i + 8])] > 1 for p in range(i, i + 8)}
    lines = [x for x in text.split("\n") if BLANKS.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(often))


def known_spans(text):
    """The fixed forms, with the runs of hexadecimal digits filtered after matching."""
    text = text or ""
    found = [("assign", *m.span()) for m in re.finditer(
        "((?:p|P)(?:a|A)(?:s|S)(?:s|S)(?:w|W)(?:o|O)(?:r|R)(?:d|D)|(?:p|P)(?:a|A)(?:s|S)(?:s|S)(?:w|W)(?:d|D)|[sS][eE][cC][rR][eE][tT]"
        "|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])[\"']? *[:=] *[\"']?([A-Za-z0-9+/_.=-]+)", text) if len(m[2]) >= 8]
    found += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(found, key=lambda s: (s[1], ("assign", "access", "hex").index(s[0])))


def contained(documents, benchmark, k=5, share=0.8):
    """{(doc_id, item_id, shared, n)} of distinct k-word shingles."""
    import math

    def shingles(text):
        words = BLANKS.findall((text or "").lower())
        return {" ".join(words[i:i + k]) for i in range(len(words) - k + 1)} or ({" ".join(words)} if words else set())

    out = set()
    items = [(i, shingles(t)) for i, t in benchmark]
    for doc_id, text in documents:
        own = shingles(text)
        for item_id, item in items:
            if item and len(own & item) >= math.ceil(share * len(item)):
                out.add((doc_id, item_id, len(own & item), len(item)))
    return out
