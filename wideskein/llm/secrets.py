"""Secret scan: candidates by pattern, false positives removed by a random forest.

A candidate is a run of at least ``LEAST`` letters, digits and ``+/_-.:~`` anywhere in the whole text, without marks at
its ends but with what ``=`` pads it, if it holds a digit, has ``LONG`` characters or more, or is assigned (a quote, ``=`` or ``:`` stands before it).
Its features are its length, how likely its character transitions are among the corpus's words, entropy and character
classes, the share of it that dictionary words cover, its path (``source``), and its neighbouring words. Transition
counts and the dictionary come from all documents: words that make up one part in ``RARE`` of them or more, so never
more than ``RARE`` words. The forest is trained by Spark on labelled findings (doc_id, start, label), at most about
``SAMPLE`` of either label, picked by a hash.

The corpus tables hold no labelled findings, so :func:`label_findings` gives the query's, by where a finding stands,
which no feature tells: true if it stands in quotes after an assignment and is no placeholder, false if it stands in
running text, after a space or a bracket, and no ``=`` or ``:`` before that. All others have no label and are judged by
the forest alone. (A secret in running text is a wrong label; the forest, which sees what it looks like, outvotes it.)

Defined cases. A null or empty text has no candidates. Repeated rows give repeated findings. A null doc_id or
source is scanned like any other; an absent source column counts as null. Without findings of both labels every
candidate gets score 0. An empty table gives an empty result. Other columns are ignored. Findings carry a hash
and a masked preview, never the secret.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wideskein.llm.common import cut, slices

LEAST = 8
LONG = 16
RARE = 100_000
SAMPLE = 4000
TREES = 24
DEPTH = 8
SEED = 13
_RUN = re.compile(rf"[A-Za-z0-9+/_\-.:~]{{{LEAST},}}={{0,2}}")
_MARKS = "-.:~"
_DIGIT = re.compile("[0-9]")
_ASSIGNS = frozenset("=:\"'`")
_WORDS = re.compile(r"[^\W\d_]+")
#: Words that name credentials, and words that mark placeholders.
CREDENTIAL = {"token", "secret", "password", "passwd", "pwd", "key", "apikey", "credential", "credentials", "auth", "bearer", "private"}
PLACEHOLDER = {"example", "sample", "test", "dummy", "placeholder", "changeme", "your", "xxxx"}
FEATURES = ["length", "transition", "entropy", "digits", "upper", "marks", "changes", "hex", "coverage", "repeats", "credential", "path_test", "path_config", "before_known", "after_known"]
_CONTEXT = 64


def _classes(raw: bytes) -> np.ndarray:
    """Letters 0-25 whatever their case, digits 26, all else 27."""
    b = np.frombuffer(raw, dtype=np.uint8)
    low = b | 0x20
    out = np.full(len(b), 27, dtype=np.int64)
    letters = (low >= 97) & (low <= 122)
    out[letters] = low[letters] - 97
    out[(b >= 48) & (b <= 57)] = 26
    return out


@dataclass
class Language:
    """What the corpus's words look like: log probabilities of character transitions, and its frequent words."""

    transitions: np.ndarray
    words: frozenset[str]

    def coverage(self, text: str) -> float:
        """Share of the characters in the longest dictionary words that tile the text, three letters at least."""
        low, n, best = text.lower(), len(text), [0] * 13
        # ``best`` is a ring: the place of i holds the most characters covered of the first i, for the next twelve.
        for i in range(n):
            here = best[i % 13]
            best[i % 13] = 0
            best[(i + 1) % 13] = max(best[(i + 1) % 13], here)
            for k in range(3, min(12, n - i) + 1):
                if low[i : i + k] in self.words:
                    best[(i + k) % 13] = max(best[(i + k) % 13], here + k)
        return best[n % 13] / n

    def features(self, text: str, before: str, after: str, path: str) -> list[float]:
        c = _classes(text.encode())
        counts = np.array(list(Counter(text).values())) / len(text)
        near = [w.lower() for w in _WORDS.findall(before)]
        after_words = [w.lower() for w in _WORDS.findall(after)]
        kind = [ch.isdigit() + 2 * ch.isupper() for ch in text]
        return [
            math.log(len(text)),
            float(self.transitions[c[:-1], c[1:]].mean()),
            float(-(counts * np.log2(counts)).sum()),
            sum(ch.isdigit() for ch in text) / len(text),
            sum(ch.isupper() for ch in text) / len(text),
            sum(not ch.isalnum() for ch in text) / len(text),
            sum(a != b for a, b in zip(kind, kind[1:], strict=False)) / (len(text) - 1),
            float(re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", text) is not None),
            self.coverage(text),
            1.0 - len(set(text)) / len(text),
            float(bool(CREDENTIAL & set(near[-3:]))),
            float(bool(re.search(r"test|example|doc|fixture", path.lower()))),
            float(bool(re.search(r"conf|env|secret|cred|ya?ml|ini", path.lower()))),
            float(bool(near) and near[-1] in self.words),
            float(bool(after_words) and after_words[0] in self.words),
        ]


def learn_language(docs: DataFrame, rare: int = RARE) -> Language:
    """Transition counts and the words of three to twelve letters that are one in ``rare`` or more (twice at least), over all texts."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(keys: list[str], n: list[int]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(n, pa.int64())], names=["key", "n"])

        pairs, words = np.zeros(28 * 28, dtype=np.int64), Counter()
        for batch in slices(batches):
            joined = "\n".join(t for t in batch.column(0).to_pylist() if t)
            c = _classes(joined.encode("utf-8", "surrogatepass"))
            pairs += np.bincount(c[:-1] * 28 + c[1:], minlength=28 * 28)
            words.update(joined.lower().split())
            if len(words) > 200_000:
                yield out(list(words), list(words.values()))
                words.clear()
        at = np.flatnonzero(pairs)
        yield out([*words, *(f"\t{i}" for i in at)], [*words.values(), *pairs[at].tolist()])

    counts = docs.select(F.col("text").cast("string")).mapInArrow(run, "key string, n long")
    # Words keep their letters only, so that punctuation does not part them.
    word = F.regexp_extract("key", r"^[^\p{L}\p{N}\t]*(\p{L}{3,12})[^\p{L}\p{N}]*$", 1)
    key = F.when(F.col("key").startswith("\t"), F.col("key")).otherwise(word)
    table = cut(counts.select(key.alias("key"), "n").where("key <> ''").groupBy("key").agg(F.sum("n").alias("n")), "secret-words")
    pairs = np.ones(28 * 28)
    for r in table.where(F.col("key").startswith("\t")).collect():
        pairs[int(r.key[1:])] += r.n
    pairs = pairs.reshape(28, 28)
    known = table.where(~F.col("key").startswith("\t"))
    total = known.agg(F.sum("n")).first()[0] or 0
    frequent = known.where((F.col("n") > 1) & (F.col("n") * F.lit(rare) >= F.lit(total))).select("key").toArrow()["key"].to_pylist()  # RARE words at most
    return Language(np.log(pairs / pairs.sum(axis=1, keepdims=True)), frozenset(frequent))


def found_in(text: str) -> Iterator[tuple[int, int]]:
    """Where the candidates of a text begin and end."""
    for m in _RUN.finditer(text):
        run, a, b = m.group(), m.start(), m.end()
        if not run.isalpha():
            a, b = a + len(run) - len(run.lstrip(_MARKS)), b - len(run) + len(run.rstrip(_MARKS))
        elif len(run) < LONG and text[a - 1 : a] not in _ASSIGNS:
            continue  # a word
        if b - a >= LONG or b - a >= LEAST and (text[max(0, a - 1) : a] in _ASSIGNS or _DIGIT.search(text, a, b)):
            yield a, b


_QUOTED = re.compile(r"[\w\])][\"'`]?\s*[=:]>?\s*[\"'`]$")
_RUNNING = re.compile(r"(?:^|[^=:\s]\s+|[(\[{])$")


def place_of(text: str, a: int, b: int) -> str:
    """How the finding stands: ``quoted`` after an assignment, in ``running`` text, as a ``placeholder``, or neither."""
    before = text[max(0, a - _CONTEXT) : a]
    if _QUOTED.search(before) and text[b : b + 1] == before[-1:]:
        low = text[a:b].lower()
        return "placeholder" if any(p in low for p in PLACEHOLDER) else "quoted"
    return "running" if _RUNNING.search(before) and (text[b : b + 1] or " ") in " \n\t\r,.;!?)" else "other"


def candidates(docs: DataFrame, language: Language) -> DataFrame:
    """doc_id, start, end, sha256, preview, place and features of every candidate."""
    held = docs.sparkSession.sparkContext.broadcast(language)
    schema = "doc_id long, start long, end long, sha256 string, preview string, place string, features array<double>"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.list_(pa.float64())]
        for batch in slices(batches):
            rows: list[tuple] = []
            for doc_id, text, path in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for a, b in found_in(text or ""):
                    found = text[a:b]
                    features = held.value.features(found, text[max(0, a - _CONTEXT) : a], text[b : b + _CONTEXT], path or "")
                    rows.append((doc_id, a, b, hashlib.sha256(found.encode()).hexdigest(), found[:4] + "*" * 8, place_of(text, a, b), features))
            columns = list(zip(*rows, strict=True)) or [()] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["doc_id", "start", "end", "sha256", "preview", "place", "features"])

    path = F.col("source").cast("string") if "source" in docs.columns else F.lit(None).cast("string")
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), path.alias("path")).mapInArrow(run, schema)


def label_findings(found: DataFrame) -> DataFrame:
    """doc_id, start, label of the candidates whose place decides."""
    label = F.when(F.col("place") == "quoted", 1.0).when(F.col("place").isin("running", "placeholder"), 0.0)
    return found.select("doc_id", "start", label.alias("label")).where("label is not null")


def train(found: DataFrame, labelled: DataFrame, sample: int = SAMPLE, trees: int = TREES, depth: int = DEPTH) -> RandomForestClassificationModel | None:
    """A random forest learned from a bounded sample of ``labelled`` (doc_id, start, label); none without both labels."""
    named = found.join(labelled.dropDuplicates(["doc_id", "start"]), ["doc_id", "start"]).select("doc_id", "start", "label", "features")
    sizes = {r.label: r.n for r in named.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(sizes) < 2:
        return None
    share = F.when(F.col("label") == 1, F.lit(sample / sizes[1.0])).otherwise(F.lit(sample / sizes[0.0]))
    picked = named.where(F.pmod(F.xxhash64("doc_id", "start", F.lit(SEED)), F.lit(1 << 30)) < share * (1 << 30))
    # Both labels weigh alike. The sample is small; one task in a fixed order makes the same forest each time.
    weight = F.when(F.col("label") == 1, F.lit(1.0 / min(sample, sizes[1.0]))).otherwise(F.lit(1.0 / min(sample, sizes[0.0])))
    rows = cut(picked.select("label", array_to_vector("features").alias("vector"), (weight * min(*sizes.values(), sample)).alias("weight"), "doc_id", "start"), "secret-train").coalesce(1).sortWithinPartitions("doc_id", "start")
    return RandomForestClassifier(featuresCol="vector", labelCol="label", weightCol="weight", numTrees=trees, maxDepth=depth, seed=SEED, featureSubsetStrategy="sqrt").fit(rows)


def classify(found: DataFrame, forest: RandomForestClassificationModel | None) -> DataFrame:
    """``found`` with score and secret."""
    if forest is None:
        return found.select("*", F.lit(0.0).alias("score"), F.lit(False).alias("secret"))
    scored = forest.transform(found.withColumn("vector", array_to_vector("features")))
    score = vector_to_array("probability")[1]
    return scored.select(*found.columns, score.alias("score"), (score >= 0.5).alias("secret"))


def scan(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """Every candidate of every document with its score; ``labelled`` findings default to :func:`label_findings`."""
    found = cut(candidates(docs, learn_language(docs)), "secret-candidates")
    return classify(found, train(found, label_findings(found) if labelled is None else labelled))
