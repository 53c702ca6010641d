"""Secret scans: patterns for known forms, character Markov models for the rest.

Two first-order Markov models over characters, one of random strings and one of
ordinary identifiers, are trained from labelled samples.  A long token without
blanks is a secret if the logarithm of the models' likelihood ratio is high,
in sum and a character.  Tokens are runs of ASCII letters, digits and ``+/_=-``:
other characters end them, letters of other scripts and accented ones too.  The random sample is the strings that the known forms
found in a bounded set of documents and random strings over the usual alphabets.
The ordinary sample is surely ordinary tokens (plain words and numbers of these
documents, and identifiers of the words in the usual styles) and those of the
documents' other tokens that models of these samples call more ordinary than
random: they have no label, and a bare key among them must not be learnt as
ordinary.  Strings and identifiers are drawn from fixed seeds.  The cut is set
from other identifiers: a margin above a high quantile of theirs.  No token of
the documents sets it.  The ratio decides on every token of ``least_length``
characters or more, but for UUIDs: these are identifiers by policy.
"""

from __future__ import annotations

import random
import re
import string
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import map_arrow, map_rows, slices

#: Fixed forms, in the order in which ties are listed.
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                     re.ASCII | re.IGNORECASE)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")  # same spans as all runs of 32 and more
_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
KINDS = ("assign", "access", "hex", "markov")

#: The shortest token that is judged by default.
LEAST_LENGTH = 16


def _token_pattern(least_length: int) -> re.Pattern:
    """A token that the models judge: all of a run of these characters, whatever else touches it."""
    return re.compile(r"(?<![A-Za-z0-9_])[A-Za-z0-9+/_=-]{%d,}(?![A-Za-z0-9_])" % least_length)


#: What they may learn as ordinary: shorter tokens too.
_LEARNT = re.compile(r"(?<![A-Za-z0-9_])[A-Za-z0-9+/_=-]{4,}(?![A-Za-z0-9_])")
_ALPHABETS = (string.hexdigits[:16], string.ascii_uppercase + "234567", string.ascii_letters + string.digits,
              string.ascii_letters + string.digits + "+/", string.ascii_letters + string.digits + "-_",
              string.ascii_lowercase + string.digits, string.ascii_uppercase + string.digits, string.ascii_lowercase,
              string.ascii_uppercase)
_CODE = {c: i for i, c in enumerate(string.ascii_letters + string.digits + "+/_=-.")}
_EDGE = len(_CODE)
#: A token that is surely ordinary: a word too short to be judged, of one case but for its first letter; and no letters.
_PLAIN = re.compile(r"[A-Za-z]?[a-z]{1,14}|[A-Z]{1,15}")
_UUID = re.compile(r"[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}", re.IGNORECASE)
_NUMBER = re.compile(r"[0-9+/_=-]+")
#: Words besides the documents' own, which may have none.
_COMMON = """about access account action address after amount array author base before block body build cache call change
    check child class client close code column command common config content control count create current custom data date
    default delete detail device document domain each element email enable error event example export false field file filter
    first folder format frame from function general global group handle have header height image import index info inner input
    internal item january layer length level library like limit line link list load local main manager master member message
    method model module name network next node null number object option order outer output owner page parent part path people
    point price process product project property public query range read record reference remove report request result return
    root route rule same schema search select server service session shared simple size small source start state status step
    stream string style system table target task template test text their thread time title total tree type under union unique
    update user value version view widget width window with word work world write year""".split()

Span = tuple[str, int, int]


def known_spans(text: str) -> list[Span]:
    """Spans of the known forms in code points, leftmost and not overlapping within a kind."""
    found: list[Span] = []
    low = text.lower()
    if any(w in low for w in _WORDS):
        found += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in _ACCESS.finditer(text) if len(m[0]) >= 16]
    return found + [("hex", *m.span()) for m in _HEX.finditer(text)]


def _ordered(spans: Iterable[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def join_spans(spans: Iterable[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


class Models:
    """``ratio[a, b]``: log likelihood of b after a among random strings less that among ordinary ones."""

    def __init__(self, ratio: np.ndarray, per_char: float, least: float, least_length: int = LEAST_LENGTH):
        self.ratio, self.per_char, self.least, self.least_length = ratio.tolist(), per_char, least, least_length
        self._token = _token_pattern(least_length)

    def evidence(self, token: str) -> float:
        """Log likelihood ratio of the whole token, its start and end included."""
        total, at, ratio = 0.0, _EDGE, self.ratio
        for c in token:
            to = _CODE[c]
            total += ratio[at][to]
            at = to
        return total + ratio[at][_EDGE]

    def is_secret(self, token: str) -> bool:
        if _UUID.fullmatch(token) or not any(map(str.isalnum, token)):
            return False  # an identifier by policy, or a ruled line
        got = self.evidence(token)
        return got >= self.least and got >= self.per_char * len(token)

    def spans(self, text: str) -> list[Span]:
        """All spans of a text: the known forms, and tokens apart from them that the models call random."""
        found = known_spans(text)
        taken = sorted((a, b) for _, a, b in found)
        starts = [a for a, _ in taken]
        for m in self._token.finditer(text):
            if self.is_secret(m[0]):
                i = bisect_left(starts, m.end())
                if not any(b > m.start() for _, b in taken[:i]):
                    found.append(("markov", *m.span()))
        return _ordered(found)


def _counts(samples: Iterable[str]) -> np.ndarray:
    """Transitions with one state for a token's start and end."""
    counts = np.zeros((_EDGE + 1, _EDGE + 1))
    for s in samples:
        path = [_EDGE, *[_CODE[c] for c in s], _EDGE]
        np.add.at(counts, (path[:-1], path[1:]), 1)
    return counts


def _log(counts: np.ndarray) -> np.ndarray:
    """Smoothed log transition probabilities."""
    counts = counts + 0.5
    return np.log(counts / counts.sum(axis=1, keepdims=True))


def random_strings(count: int = 9000, seed: int = 13) -> list[str]:
    """Random strings of 16 to 48 characters over the usual alphabets, in turn."""
    rng = random.Random(seed)
    return ["".join(rng.choices(_ALPHABETS[i % len(_ALPHABETS)], k=rng.randint(16, 48))) for i in range(count)]


_ACRONYMS = ("HTTP", "XML", "URL", "API", "ID", "JSON", "SQL", "UI", "IO", "AST", "CSS", "CPU", "TCP", "UTF8", "DB")
_SYSTEM = ("/usr/lib", "/etc", "/var/log", "/opt", "lib", "src", "x86_64-linux-gnu", "v1", "v2beta1", "k8s-io", "amd64", "arm64",
           "node_modules", "python3", "libstdc", "utf-8", "sha256", "tmp", "bin")
_ENDS = ("csv", "json", "py", "txt", "log", "gz", "html", "so")


def identifiers(words: list[str], count: int = 12_000, seed: int = 17) -> list[str]:
    """Ordinary identifiers in the usual styles, made of the given words.

    In turn: snake, kebab, path, capitals in camel case, numbered; lower camel
    case, camel case with acronyms, upper snake with numbers, system paths with
    files, versions, timestamps with a name, and words run together.
    """
    if not words:
        return []
    rng, out = random.Random(seed), []
    for i in range(count):
        own = [w.strip("+/_=-") for w in rng.choices(words, k=rng.randint(2, 6))]
        own = [w.lower() for w in own if w] or ["name"]
        style = i % 12
        if style < 3:
            name = "_-/"[style].join(own)
        elif style == 3:
            name = "".join(w.capitalize() for w in own)
        elif style == 4:
            name = f"{'-'.join(own)}-{rng.randint(1, 2030)}"
        elif style == 5:
            name = own[0] + "".join(w.capitalize() for w in own[1:])
        elif style == 6:
            at = rng.randrange(len(own) + 1)
            name = "".join(w.capitalize() for w in own[:at]) + rng.choice(_ACRONYMS) + "".join(w.capitalize() for w in own[at:])
        elif style == 7:
            name = "_".join(own).upper() + rng.choice(("", f"_{rng.randint(0, 64)}"))
        elif style == 8:
            name = f"{rng.choice(_SYSTEM)}/{rng.choice(_SYSTEM)}/{'_'.join(own[:2])}-{rng.choice(_ENDS)}"
        elif style == 9:
            name = f"{'-'.join(own[:3])}-{rng.choice(_SYSTEM)}-{rng.randint(0, 20)}-{rng.randint(0, 99)}-{rng.randint(0, 9)}"
        elif style == 10:
            stamp = f"{rng.randint(1990, 2030)}-{rng.randint(1, 12):02d}-{rng.randint(1, 28):02d}"
            if rng.random() < 0.6:
                stamp += f"T{rng.randint(0, 23):02d}-{rng.randint(0, 59):02d}-{rng.randint(0, 59):02d}-{rng.randint(0, 999):03d}Z"
            name = f"{stamp}-{'-'.join(own[:2])}"
        else:
            name = "".join(own)
        out.append(name)
    return out


def train(secrets: list[str], tokens: list[str], margin: float = 0.05, least_length: int = LEAST_LENGTH) -> Models:
    """Models from random strings and the tokens of documents, which may hold secrets without a known form.

    The limit a character lies ``margin`` above what one in a thousand fresh
    identifiers of ``least_length`` characters or more reaches, made of words
    that the models have not learnt, and never under zero; the sum must reach 12 (a ratio of over 100,000).
    """
    plain = [t for t in tokens if _PLAIN.fullmatch(t)]
    # the documents' words and common English ones; the limit is for words that were not learnt
    learnt, others = ([[w for w in ws if (crc32(w.lower().encode()) % 3 == 2) == out] for ws in (plain, _COMMON)]
                      for out in (False, True))
    random_ = _log(_counts(secrets))
    sure = _counts([t for t in tokens if _NUMBER.fullmatch(t)] + [t for ws in learnt for t in ws + identifiers(ws)])
    first = Models(random_ - _log(sure), 0.0, 12.0)
    mixed = Counter(t for t in tokens if not (_PLAIN.fullmatch(t) or _NUMBER.fullmatch(t)))
    ratio = random_ - _log(sure + _counts(t for t, n in mixed.items() if first.evidence(t) < 0 for _ in range(n)))
    own = Models(ratio, 0.0, 12.0, least_length)
    for ws in others:
        fresh = [own.evidence(t) / len(t) for t in identifiers(ws, seed=19) if len(t) >= least_length]
        if fresh:
            own.per_char = max(own.per_char, float(np.quantile(fresh, 0.999)) + margin)
    return own


def samples_of(texts: Iterable[str]) -> tuple[list[str], list[str]]:
    """Strings in known forms, and the tokens that touch none of them (each once a text, hashes and runs of digits too)."""
    secrets, tokens = [], []
    for text in texts:
        known = known_spans(text)
        for kind, a, b in known:
            own = text[a:b]
            secrets.append(_ASSIGN.fullmatch(own)[2] if kind == "assign" else own)
        rest, at = [], 0
        for _, a, b in sorted(known, key=lambda s: s[1:]):
            rest.append(text[at:max(at, a)])
            at = max(at, b)
        rest.append(text[at:])
        tokens += sorted({m[0] for part in rest for m in _LEARNT.finditer(part)})
    return secrets, tokens


def fit(documents: DataFrame, rows: int = 1500, max_chars: int = 20_000, least_length: int = LEAST_LENGTH) -> Models:
    """Train from at most ``rows`` documents (least hash of their id) of at most ``max_chars`` characters each.

    Of an id that several rows have, the text with the least hash is taken.
    """
    ids = [r["doc_id"] for r in documents.select("doc_id").where("doc_id IS NOT NULL").distinct()
           .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows).collect()]
    spark = documents.sparkSession
    picked = spark.createDataFrame([(i,) for i in ids], "doc_id long")
    texts = [r["text"] for r in documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
             .where(F.length("text") <= max_chars).join(F.broadcast(picked), "doc_id").groupBy("doc_id")
             .agg(F.min_by("text", F.xxhash64("text")).alias("text")).select("text").distinct().collect()]
    secrets, tokens = samples_of(sorted(texts))
    return train(secrets + random_strings(), tokens, least_length=least_length)


def secret_spans(documents: DataFrame, models: Models) -> DataFrame:
    """(doc_id, spans) for every row: spans as an array of (kind, start, end) in code points, end exclusive.

    Null and empty texts have no spans.  Repeated rows are scanned alike.
    """
    known = documents.sparkSession.sparkContext.broadcast(models)  # a fixed 69 x 69 table

    def make():
        scan = known.value.spans

        def work(rows):
            return {"doc_id": rows["doc_id"], "spans": [
                [{"kind": k, "start": a, "end": b} for k, a, b in scan(t or "")] for t in rows["text"]]}
        return work

    return map_rows(documents.select("doc_id", "text"),
                    "doc_id long, spans array<struct<kind: string, start: long, end: long>>", make)


def summary(found: DataFrame) -> DataFrame:
    """Counts and the spans as text, from ``secret_spans``."""
    text = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    base = F.filter("spans", lambda s: s["kind"] != "markov")

    def of(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    count = [of(kind) for kind in KINDS]
    return found.select("doc_id", *count[:3], F.sha2(F.array_join(F.transform(base, text), ","), 256).alias("base_sha256"),
                        F.array_join(F.transform("spans", text), ",").alias("spans"), count[3])


def masked(text: str, spans: Iterable[Span], mask: str = "[SECRET]") -> str:
    """The text with every run of overlapping spans replaced by the mask."""
    out, at = [], 0
    for _, a, b in sorted(spans, key=lambda s: s[1:]):
        if a >= at:
            out += [text[at:a], mask]
        at = max(at, b)
    return "".join(out) + text[at:]


def mask_secrets(documents: DataFrame, models: Models, mask: str = "[SECRET]") -> DataFrame:
    """``documents`` with secrets replaced in ``text`` and ``n_chars`` (if there) counted anew for changed rows.

    All rows and columns stay; null texts stay null.
    """
    known = documents.sparkSession.sparkContext.broadcast(models)
    names = documents.columns
    at, length = names.index("text"), names.index("n_chars") if "n_chars" in names else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = known.value.spans
        for piece in slices(batches):
            texts = piece.column(at).to_pylist()
            clean = [t and (masked(t, found, mask) if (found := scan(t)) else t) for t in texts]
            columns = list(piece.columns)
            columns[at] = pa.array(clean, columns[at].type)
            if length is not None:
                sizes = [len(c) if c != t else n for c, t, n in zip(clean, texts, columns[length].to_pylist())]
                columns[length] = pa.array(sizes, columns[length].type)
            yield pa.RecordBatch.from_arrays(columns, schema=piece.schema)

    return map_arrow(documents, run, documents.schema)

