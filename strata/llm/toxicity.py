"""Toxicity by a learned lexicon, matched with a Levenshtein automaton.

The lexicon is learned from labelled rows: words whose documents are toxic far more often than
others (likelihood ratio ``MIN_RATIO``, log odds ``MIN_ODDS``). Its trie is intersected with the
automaton for one edit (a letter changed, added, left out or swapped with the next; words of
``FUZZY_LENGTH`` letters up) by following the subsets of both that the texts reach: a table of
subsets and letters runs over all words of a block at once and gains the entries that are missing.
Words are the runs without white space, from their first to their last letter or digit, and, in a run
that does not match, its pieces between other characters. A letter that stands three or more times in
a row counts once. Misspellings that clean training documents hold are no matches. A match between
quotation marks within ``WINDOW`` characters is counted apart from the others, so that quoting weighs
differently from abusing. A logistic regression on these counts gives the score.

Learning takes a bounded sample: of each label about ``LEARN_ROWS`` ids, those whose hash is small,
found in the labels alone, so that no text is shuffled to meet its label. The lexicon is learned from all
of them and has no bound besides; what is broadcast is the lexicon and the misspellings of clean
documents around it. The regression takes about ``FIT_ROWS`` rows of each label by another hash,
weighted by how many labels there are.

Defined results: null and empty text have no match and get the score of such texts; a null id counts
as the empty string in hashes and has no label; of several labels of an id the largest holds;
without labelled rows of both kinds every score is the share of toxic ones, or 0.1 without any; each
input row gives one output row, repeated or not; an empty table gives an empty table.
"""

from __future__ import annotations

import functools
import unicodedata
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from strata.llm.blocks import slices, table_path, utf8
from strata.workspace import materialize

MIN_RATIO = 20.0
MIN_ODDS = 3.0
FUZZY_LENGTH = 5
WINDOW = 60
LEARN_ROWS = 1 << 15
FIT_ROWS = 8192
MOST_STATES = 1 << 16  # after a block with more the table begins anew
THRESHOLD = 0.3
FEATURES = 5
PENALTY = 0.05
# Quotation marks.
QUOTES = "\"“”„‟«»‹›"


class Lexicon(NamedTuple):
    """Words, and strings one edit away from them that are no misspellings."""

    words: list[str]
    clean: frozenset[str]


class Automaton:
    """The words' trie and the automaton for one edit, as subsets of both that are numbered when first reached.

    A position is (node of the trie, edits, letter still due of a swap). State 0 is the empty subset, 1 the begin.
    """

    def __init__(self, words: list[str]):
        self.children: list[dict[str, int]] = [{}]
        self.final: list[int] = [0]
        for word in sorted(set(words)):
            node = 0
            for letter in word:
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.final.append(0)
                node = self.children[node][letter]
            self.final[node] = len(word)
        self.letters = sorted({c for node in self.children for c in node})
        self.width = len(self.letters) + 1  # the last column is any other character
        self.reset()

    def reset(self) -> None:
        start = self._close({(0, 0, "")})
        self.subsets = [frozenset(), start]
        self.number = {self.subsets[0]: 0, start: 1}
        self.table = np.full((64, self.width), -1, np.int32)
        self.table[0] = 0
        self.kind = np.zeros(64, np.int8)  # by state: 0 no match, 1 a word, 2 one edit away

    def _close(self, positions: set) -> frozenset:
        """With letters left out; an exact position covers the edited one at its node."""
        more = {(c, 1, "") for n, e, wait in positions if e == 0 and not wait for c in self.children[n].values()}
        every = positions | more
        return frozenset(p for p in every if not (p[1] == 1 and not p[2] and (p[0], 0, "") in every))

    def _step(self, positions: frozenset, letter: str) -> frozenset:
        out = set()
        for node, edits, wait in positions:
            if wait:
                if letter == wait:
                    out.add((node, 1, ""))
                continue
            if letter in self.children[node]:
                out.add((self.children[node][letter], edits, ""))
            if edits == 0:
                out.add((node, 1, ""))
                for first, child in self.children[node].items():
                    out.add((child, 1, ""))
                    if first != letter and letter in self.children[child]:
                        out.add((self.children[child][letter], 1, first))
        return self._close(out)

    def _accepts(self, positions: frozenset) -> int:
        if any(e == 0 and self.final[n] for n, e, w in positions if not w):
            return 1
        return 2 if any(self.final[n] >= FUZZY_LENGTH for n, e, w in positions if e and not w) else 0

    def next(self, state: np.ndarray, column: np.ndarray) -> np.ndarray:
        """The states after a character each."""
        found = self.table[state, column]
        missing = found < 0
        if missing.any():
            for key in np.unique(state[missing].astype(np.int64) * self.width + column[missing]).tolist():
                at, place = divmod(key, self.width)
                target = self._step(self.subsets[at], self.letters[place] if place < len(self.letters) else "")
                if target not in self.number:
                    new = self.number[target] = len(self.subsets)
                    self.subsets.append(target)
                    if new == len(self.table):
                        self.table = np.concatenate([self.table, np.full_like(self.table, -1)])
                        self.kind = np.concatenate([self.kind, np.zeros_like(self.kind)])
                    self.kind[new] = self._accepts(target)
                self.table[at, place] = self.number[target]
            found = self.table[state, column]
        return found


@functools.lru_cache(1)
def _classes() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """By code point: letter or digit, letter, part of a word piece (marks too), white space."""
    points = np.arange(0x110000, dtype="<u4")
    points[0xD800:0xE000] = 0  # no characters
    every = points.tobytes().decode("utf-32-le")
    solid = np.fromiter((c.isalnum() for c in every), bool, len(every))
    letter = np.fromiter((c.isalpha() for c in every), bool, len(every))
    part = solid | np.fromiter((unicodedata.category(c)[0] == "M" for c in every), bool, len(every))
    return solid, letter, part, np.fromiter((c.isspace() for c in every), bool, len(every))


class Words(NamedTuple):
    """The words of some texts."""

    chars: np.ndarray  # code points of all texts, lower-case, each text with a line break behind it
    ends: np.ndarray  # of each text in the code points
    starts: np.ndarray  # runs first, then pieces
    stops: np.ndarray
    run: np.ndarray  # the run that a word is or lies in
    runs: int

    def text(self, word: int) -> str:
        return self.chars[self.starts[word] : self.stops[word]].astype("<u4").tobytes().decode("utf-32-le", "replace")


def split(texts: list[str]) -> Words:
    """The runs without white space, from first to last letter or digit, and the pieces of those that have several."""
    solid_of, letter_of, part_of, white_of = _classes()
    lower = [t.lower() + "\n" for t in texts]
    chars = np.frombuffer("".join(lower).encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum([len(t) for t in lower])
    same = np.zeros(len(chars) + 1, bool)
    same[1:-1] = (chars[1:] == chars[:-1]) & letter_of[chars[1:]]
    longer = same[:-1] & (same[1:] | np.append(False, same[:-2]))
    if longer.any():
        ends = ends - np.cumsum(longer)[ends - 1]
        chars = chars[~longer]
    solid, part = solid_of[chars], part_of[chars]
    gap = np.maximum.accumulate(np.where(white_of[chars], np.arange(len(chars)), -1))
    own = np.flatnonzero(solid)
    if not len(own):
        return Words(chars, ends, *(np.zeros(0, np.int64),) * 3, 0)
    fresh = np.append(True, gap[own[1:]] != gap[own[:-1]])
    starts, stops = own[fresh], own[np.append(fresh[1:], True)] + 1
    # pieces: letters, digits and marks in a row, of runs that hold something else
    broken = np.append(0, np.cumsum(~part))
    several = broken[stops] > broken[starts]
    begin = own[np.append(True, broken[own[1:]] != broken[own[:-1]])]
    finish = own[np.append(broken[own[1:]] != broken[own[:-1]], True)] + 1
    inside = np.searchsorted(starts, begin, side="right") - 1
    keep = several[inside]
    return Words(
        chars, ends, np.append(starts, begin[keep]), np.append(stops, finish[keep]),
        np.append(np.arange(len(starts)), inside[keep]), len(starts))


class Matcher:
    """A lexicon ready to run over blocks of text. Lives in one worker."""

    def __init__(self, lexicon: Lexicon):
        self.clean = lexicon.clean
        self.automaton = Automaton(lexicon.words)
        self.column = np.full(0x110000, self.automaton.width - 1, np.int32)
        self.column[[ord(c) for c in self.automaton.letters]] = np.arange(self.automaton.width - 1)

    def kinds(self, words: Words) -> np.ndarray:
        """0 for no match, 1 for a word of the lexicon, 2 for a misspelling, for each word."""
        if len(self.automaton.subsets) > MOST_STATES:
            self.automaton.reset()
        kinds = np.zeros(len(words.starts), np.int8)
        live, depth = np.arange(len(words.starts)), 0
        state = np.ones(len(live), np.int64)
        columns = self.column[words.chars]
        sizes = words.stops - words.starts
        while len(live):
            state = self.automaton.next(state, columns[words.starts[live] + depth]).astype(np.int64)
            depth += 1
            done = sizes[live] == depth
            kinds[live[done]] = self.automaton.kind[state[done]]
            on = ~done & (state > 0)
            live, state = live[on], state[on]
        for word in np.flatnonzero(kinds == 2):
            if words.text(word) in self.clean:
                kinds[word] = 0
        whole = kinds[: words.runs] > 0
        kinds[words.runs :][whole[words.run[words.runs :]]] = 0
        return kinds

    def matches(self, texts: list[str]) -> tuple[np.ndarray, ...]:
        """(text, kind, quoted) of each match, and the number of words of each text."""
        words = split(texts)
        chars, ends, starts, stops = words.chars, words.ends, words.starts, words.stops
        counts = np.bincount(np.searchsorted(ends, starts[: words.runs], side="right"), minlength=len(texts))
        kinds = self.kinds(words)
        word = np.flatnonzero(kinds)
        kind, row = kinds[word], np.searchsorted(ends, starts, side="right")
        marks = np.flatnonzero(np.isin(chars, np.array([ord(c) for c in QUOTES], np.uint32)))
        edges = np.concatenate([[-(1 << 40)], marks, [1 << 40]])
        after = np.searchsorted(marks, starts[word])
        left, right = edges[after], edges[np.searchsorted(marks, stops[word]) + 1]
        first = np.concatenate([[0], ends])[row[word]]
        # an odd number of marks before a word, in its text, means that a quotation is open
        open_before = (after - np.searchsorted(marks, first)) % 2 == 1
        quoted = open_before & (left >= np.maximum(first, starts[word] - WINDOW)) & (right < np.minimum(ends[row[word]], stops[word] + WINDOW))
        return row[word], kind.astype(np.int64), quoted.astype(np.int64), counts

    def features(self, texts: list[str]) -> np.ndarray:
        """Logarithmic counts of plain and quoted words and misspellings, and of all words."""
        row, kind, quoted, counts = self.matches(texts)
        table = np.zeros((len(texts), FEATURES))
        np.add.at(table, (row, 2 * (kind - 1) + quoted), 1)
        table[:, 4] = counts / 100
        return np.log1p(table)


def _labelled(df: DataFrame, labels: DataFrame, doc_id: str, text: str, toxic: str) -> DataFrame:
    """``id``, ``toxic``, ``weight`` (labels of its kind for each one sampled) and ``body`` of the sampled ids."""
    known = labels.where(F.col(doc_id).isNotNull() & F.col(toxic).isNotNull()).groupBy(F.col(doc_id).cast("long").alias("id")).agg(F.max(F.col(toxic).cast("int")).alias("toxic"))
    known = materialize(known, "labels")
    kinds = known.groupBy((F.col("toxic") > 0).alias("kind")).agg(F.count("*").alias("n"))
    chosen = known.withColumn("kind", F.col("toxic") > 0).join(F.broadcast(kinds), "kind")  # two rows
    sample = chosen.where(_share(LEARN_ROWS, F.col("n"), "id")).select("id", "toxic", F.greatest(F.lit(1.0), F.col("n") / LEARN_ROWS).alias("weight"))
    rows = df.select(F.col(doc_id).cast("long").alias("id"), utf8(text).alias("body"))
    return rows.join(F.broadcast(sample), "id").select("id", "toxic", "weight", "body")  # about 2 * LEARN_ROWS ids


def _share(rows: int, n: Column, *by: str) -> Column:
    """Whether a row is among about ``rows`` of ``n``, by a hash of ``by``."""
    return F.pmod(F.xxhash64(F.lit(rows), *by), F.lit(1 << 40)) < (F.lit(float(rows << 40)) / n)


def learn(training: DataFrame) -> tuple[Lexicon, np.ndarray, float]:
    """(lexicon, weights with the bias last, score without labels) from rows ``id``, ``toxic``, ``weight`` and ``body``."""
    training = materialize(training, "labelled")
    sizes = {r["toxic"]: r for r in training.groupBy(F.expr("toxic > 0 AS toxic")).agg(F.count("*").alias("n"), F.sum("weight").alias("all")).collect()}
    bad, good = (sizes[k]["n"] if k in sizes else 0 for k in (True, False))
    many = [sizes[k]["all"] if k in sizes else 0.0 for k in (True, False)]
    rate = many[0] / sum(many) if bad + good else 0.1

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "body", 8 << 20):
            counts: tuple[Counter, Counter] = (Counter(), Counter())
            for toxic, body in zip(batch["toxic"].to_pylist(), batch["body"].to_pylist()):
                found = split([body.decode("utf-8", "replace")])
                counts[toxic > 0].update({found.text(w) for w in np.flatnonzero(found.stops - found.starts >= 2)})
            words = sorted({*counts[0], *counts[1]})
            yield pa.RecordBatch.from_arrays(
                [pa.array(words, pa.string()), pa.array([counts[1][w] for w in words], pa.int64()), pa.array([counts[0][w] for w in words], pa.int64())],
                ["word", "bad", "good"])

    words = materialize(
        training.mapInArrow(count, "word string, bad long, good long").groupBy("word").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")), "words")
    share = F.lit(max(bad / max(bad + good, 1), 1e-9))
    a, b = F.col("bad"), F.col("good")
    n = a + b
    # twice the log likelihood ratio of the word's own share against the overall one
    ratio = 2 * (a * F.log(F.greatest(a / n, F.lit(1e-12)) / share) + b * F.log(F.greatest(b / n, F.lit(1e-12)) / (1 - share + 1e-12)))
    odds = F.log((a + 0.5) / (bad + 1.0)) - F.log((b + 0.5) / (good + 1.0))
    chosen = words.withColumn("ratio", ratio).where((F.col("ratio") >= MIN_RATIO) & (odds >= MIN_ODDS))
    lexicon = Lexicon(sorted(r["word"] for r in chosen.select("word").collect()), frozenset())  # of a bounded sample
    shared = training.sparkSession.sparkContext.broadcast(lexicon)

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(shared.value)
        for batch in batches:
            words = split(batch["word"].to_pylist())
            near = [words.text(w) for w in np.flatnonzero(matcher.kinds(words) == 2)]
            yield pa.RecordBatch.from_arrays([pa.array(near, pa.string())], ["word"])

    # at most what lies one edit around the lexicon
    clean = words.where("good > 0").select("word").mapInArrow(near, "word string").distinct().collect()
    lexicon = lexicon._replace(clean=frozenset(r["word"] for r in clean))
    if not bad or not good:
        return lexicon, np.zeros(0), rate
    shared_clean = training.sparkSession.sparkContext.broadcast(lexicon)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(shared_clean.value)
        for batch in slices(batches, "body"):
            found = matcher.features([t.decode("utf-8", "replace") for t in batch["body"].to_pylist()])
            yield pa.RecordBatch.from_arrays([batch["toxic"], pa.array(found.tolist(), pa.list_(pa.float64()))], ["toxic", "features"])

    each = [training.where(c).where(_share(FIT_ROWS, F.lit(n), "id", "body")) for c, n in (("toxic > 0", bad), ("toxic <= 0", good))]
    sample = each[0].unionByName(each[1]).mapInArrow(describe, "toxic int, features array<double>").collect()
    x = np.array([[*r["features"], 1.0] for r in sample])
    y = np.array([r["toxic"] > 0 for r in sample], np.float64)
    # rows of each label weigh as many as there are of them
    weight = np.where(y > 0, many[0] / y.sum(), many[1] / (len(y) - y.sum()))
    weight /= weight.mean()
    return lexicon, _regress(x, y, weight), rate


def _regress(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton steps, with a penalty that keeps separable data finite."""
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], PENALTY)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (p - y)) + penalty * w
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(penalty + 1e-9)
        change = np.linalg.solve(hessian, gradient)
        w -= change
        if np.abs(change).max() < 1e-9:
            break
    return w


def score(df: DataFrame, model: tuple[Lexicon, np.ndarray, float], text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep``, ``score``, and the numbers of plain and quoted words and misspellings in every text."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    source = df.select(*keep, utf8(text).alias("__text"))
    names = ["n_words", "n_quoted_words", "n_misspelt", "n_quoted_misspelt"]
    schema = df.select(*keep).schema.add("score", "double")
    for name in names:
        schema = schema.add(name, "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, weights, rate = shared.value
        matcher = Matcher(lexicon)
        for batch in slices(batches, "__text"):
            found = matcher.features([t.decode("utf-8", "replace") for t in batch["__text"].to_pylist()])
            if len(weights):
                value = 1 / (1 + np.exp(-np.clip(found @ weights[:-1] + weights[-1], -700, 700)))
            else:
                value = np.full(len(found), rate)
            counts = np.rint(np.expm1(found[:, :4])).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*(batch[c] for c in keep), pa.array(value), *(pa.array(counts[:, i]) for i in range(4))], [f.name for f in schema])

    return source.mapInArrow(run, schema)


def op4_toxicity(spark, sf_dir: str) -> DataFrame:
    """Score every whole text of ``documents``; rows whose id's crc32 is 2 modulo 4 are held out."""
    documents = spark.read.parquet(table_path(sf_dir, "documents"))
    labels = spark.read.parquet(table_path(sf_dir, "labels"))
    crc = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 4
    training = _labelled(documents.where(crc != 2), labels.where(crc != 2), "doc_id", "text", "toxic")
    found = score(documents, learn(training))
    return found.withColumn("held_out", crc == 2).select(
        "doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        "n_words", "n_quoted_words", "n_misspelt", "n_quoted_misspelt")


QUERIES = {"op4_toxicity": (op4_toxicity, None)}
