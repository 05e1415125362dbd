"""Toxicity by Levenshtein automata over a lexicon trie, with context windows (operator 1).

The lexicon is learned: words that stand in documents labelled toxic far more often than chance allows, counted once per
distinct neighbourhood (word before, word after), so copies of one text count once. Its terms form a
trie. A word of a text is found by walking the trie together with the Levenshtein automaton of that word, which
allows more edits the longer the term; look-alike signs (0 for o, @ for a) cost nothing. Each hit is
judged by a window of words around it: inside quotation marks, or near a verb of saying, it counts as
quoted. A document's hits, by closeness and context, and their density go through a logistic model that is
fitted on the sample too, held by a prior where the labels show no such case (quotation, most of all).

Defined results: null or empty texts have no hit and get the score of a text without hits; rows with a null doc_id
are not held out and never learned from; repeated rows are scored each; without labels of both kinds
the lexicon is empty and the prior alone makes the score; an empty table gives an empty result; other columns
are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlake.llm.common import batches_of_bytes, prepare, remember, staged, texts
from fleetlake.llm.labelled import LABELLED_ROWS, labelled_sample
from fleetlake.llm.words import split_words

LEXICON_TERMS = 5_000  # best words kept, and as many stems; the trie goes to every task
MIN_SUPPORT, MIN_SHARE = 4, 0.7  # witnesses of a term, and the lower bound of the share of them that are toxic
CACHE_WORDS = 1_000_000
WINDOW = 12  # words on either side that a hit's context reaches
PREDICTED_AT = 0.7

# fixed values: look-alike signs and the letters they stand for
LOOK_ALIKES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i"}
# fixed values: verbs of saying, by language (en, de, fr, es)
SAYING = frozenset("""said says say saying wrote writes called calls calling quoted quotes quote quoting word words term terms phrase slur insult insults
reported reports reporting claimed alleged shouted
sagte sagt schrieb nannte genannt zitiert wort begriff beleidigung beschimpfte
dit disait écrit écrivait appelé mot terme insulte cité citation
dijo dice escribió llamó palabra término insulto citó cita""".split())
_LETTER_OF = str.maketrans(LOOK_ALIKES)
_OPENING, _CLOSING = "\"“„«‹‘", "\"”“»›’"
_TRIM = re.compile(r"^[^\w@$]+|[^\w@$]+$")
_LETTERS = re.compile(r"[^\W\d_]")

STEM_LETTERS, STEM_WORDS = (4, 5, 6, 7), 5  # lengths of stems, and how many words of a stem make it one
HIT_FEATURES = ("exact", "near", "far", "stem", "quoted", "any_exact", "any_near", "any_far", "many_stems", "density", "stem_density")
PRIOR = np.array([-3.5, 1.0, 0.5, 0.3, 0.5, 0.1, 4.5, 4.0, 2.0, 1.0, 0.5, 0.5])  # constant, then HIT_FEATURES
PRIOR_ROWS = 1.0
CLEAN_NEAR = 0.002  # share of clean documents with a misspelling of a term, above which it must stand as it is
HITS = ("exact_hits", "near_hits", "far_hits", "stem_hits", "quoted_hits")


def allowed_edits(length: int) -> int:
    """Edits that a term of this many letters allows."""
    return 0 if length < 5 else 1 if length < 8 else 2


def build_trie(terms: list[str]) -> dict:
    """Nested dictionaries by letter; the key "" holds a term that ends there."""
    root: dict = {}
    for term in terms:
        node = root
        for letter in term:
            node = node.setdefault(letter, {})
        node[""] = term
    return root


def _next(word: str, state: tuple, letter: str, most: int) -> tuple:
    """The automaton's state (pairs of letters read and edits spent, no pair worse than another) after ``letter``."""
    best: dict[int, int] = {}

    def reach(i: int, e: int) -> None:
        if e <= most and e < best.get(i, most + 1):
            best[i] = e

    for i, e in state:
        reach(i, e + 1)  # the word lacks the letter
        if i < len(word):
            reach(i + 1, e + 1)  # another letter in its place
            for skip in range(most - e + 1):  # letters too many before it
                if i + skip < len(word) and (word[i + skip] == letter or LOOK_ALIKES.get(word[i + skip]) == letter):
                    reach(i + skip + 1, e + skip)
                    break
            if e < most and i + 1 < len(word) and word[i + 1] == letter:
                reach(-i - 2, e + 1)  # two letters swapped: the next one must be word[i]
    return tuple(sorted(best.items()))


def nearest_term(word: str, trie: dict, most: int = 2) -> tuple[str, int] | None:
    """The closest term within its allowed edits (then the first in order), by walking automaton and trie together."""
    found: tuple[int, str] | None = None
    stack = [(trie, ((0, 0),))]
    while stack:
        node, state = stack.pop()
        for letter, child in node.items():
            if letter == "":
                edits = min((len(word) - i + e for i, e in state if i >= 0), default=most + 1)
                if edits <= min(most, allowed_edits(len(child))) and (found is None or (edits, child) < found):
                    found = (edits, child)
                continue
            swapped = [(-i, e) for i, e in state if i < 0 and word[-i - 2] == letter]
            after = dict(_next(word, tuple((i, e) for i, e in state if i >= 0), letter, most))
            for i, e in swapped:
                if e < after.get(i, most + 1):
                    after[i] = e
            if after:
                stack.append((child, tuple(after.items())))
    return (found[1], found[0]) if found else None


def plain_word(word: str) -> str:
    """Lower case, without marks around it."""
    return _TRIM.sub("", word).lower()


def context(text: str) -> tuple[list[str], list[bool]]:
    """Words of a text, and whether each stands inside quotation marks that close within the text's paragraph."""
    words, quoted = text.split(), []
    open_at: int | None = None
    for i, w in enumerate(words):
        quoted.append(False)
        if open_at is None and w[0] in _OPENING:
            open_at = i
        if open_at is not None and len(w) > 1 - (open_at < i) and w.rstrip(".,;:!?)")[-1:] and w.rstrip(".,;:!?)")[-1] in _CLOSING and (open_at < i or len(w) > 1):
            for j in range(open_at, i + 1):
                quoted[j] = True
            open_at = None
        elif open_at is not None and i - open_at > 60:
            open_at = None
    return words, quoted


def hit_features(text: str, find) -> np.ndarray:
    """HIT_FEATURES of one text: hits outside quotation by kind and quoted hits, each as log(1 + n); whether there is any (three
    stems or more); hits per ten words."""
    words, quoted = context(text)
    counts = np.zeros(5)
    for i, w in enumerate(words):
        hit = find(w)
        if hit is not None:
            near = words[max(0, i - WINDOW // 2):i] + words[i + 1:i + 1 + WINDOW // 4]
            said = quoted[i] or any(plain_word(x) in SAYING for x in near)
            counts[4 if said else hit] += 1
    shares = np.minimum(np.array([counts[:3].sum(), counts[3]]) * 10 / max(len(words), 1), 1)
    return np.concatenate([np.log1p(counts), counts[:3] > 0, [counts[3] > 2], shares])


def shortened(word: str, most: int) -> set[str]:
    """The word without any up to ``most`` of its letters."""
    out = last = {word}
    for _ in range(most):
        last = {w[:i] + w[i + 1:] for w in last for i in range(len(w))}
        out = out | last
    return out


def unmasked(word: str) -> str:
    """The word with the letters that its signs look like."""
    return word.translate(_LETTER_OF)


class Trie:
    """Terms that allow the same number of edits, and a test that passes over words far from all of them."""

    def __init__(self, terms: list[str], edits: int):
        self.terms, self.edits, self.root = terms, edits, build_trie(terms)
        self.low, self.high = min(map(len, terms)) - edits, max(map(len, terms)) + edits
        # a word within so many edits (a swap is one) of a term is equal to it once each has lost at most so many letters
        self.shortened = set().union(*(shortened(x, edits) for t in terms for x in (t, unmasked(t))))

    def edits_to(self, word: str) -> int | None:
        if not self.low <= len(word) <= self.high or self.shortened.isdisjoint(shortened(unmasked(word), self.edits)):
            return None
        found = nearest_term(word, self.root, self.edits)
        return found[1] if found else None


# per byte: its letter's bit (either case), whether it is an ASCII letter or digit, whether it begins a character, and whether
# it may stand for another letter (look-alikes; first bytes of the few characters whose lower case is ASCII)
_BIT = np.array([1 << (b | 32) - 97 if chr(b).isalpha() and b < 128 else 0 for b in range(256)], "u4")
_ALNUM = np.array([b < 128 and chr(b).isalnum() for b in range(256)], "i4")
_START = np.array([b & 0xC0 != 0x80 for b in range(256)], "i4")
_SIGN = np.array([chr(b) in LOOK_ALIKES or b in (0xC4, 0xE2) for b in range(256)], "i4")


def _letter_bits(term: str) -> int:
    return int(np.bitwise_or.reduce(_BIT[list(term.encode())])) if term else 0


class Finder:
    """Kind of a word's hit (0, 1, 2: edits to its nearest term; 3: a stem), remembered for the words seen (bounded)."""

    def __init__(self, terms: list[str], stems: list[str], limits: list[tuple[str, int]]):
        self.seen: dict = {}
        limit = dict(limits)
        self.stems = build_trie(stems)
        self.short_stems = [x for x in stems if not any(x != y and x.startswith(y) for y in stems)]
        self.tries = []  # one for each number of edits that its terms allow
        for edits in (0, 1, 2):
            some = [t for t in terms if limit.get(t, allowed_edits(len(t))) == edits]
            if some:
                self.tries.append(Trie(some, edits))

    def possible(self, distinct: pa.Array) -> np.ndarray:
        """Words that may be a hit, by their letters alone: an edit takes at most one letter of a term away and adds
        at most one character."""
        words = distinct.cast(pa.large_binary())
        ends = np.frombuffer(words.buffers()[1], "<i8", len(words) + 1 + words.offset)[words.offset:]
        data = np.frombuffer(words.buffers()[2] or b"", "u1")
        if not len(words):
            return np.zeros(0, bool)
        bits = np.bitwise_or.reduceat(_BIT[data], ends[:-1])
        alnum, chars, signs = (np.add.reduceat(t[data], ends[:-1]) for t in (_ALNUM, _START, _SIGN))
        out = np.zeros(len(words), bool)
        for edits, terms in [*((t.edits, t.terms) for t in self.tries), (0, self.short_stems)]:
            for term in terms:
                missing = np.bitwise_count(np.uint32(_letter_bits(term)) & ~bits)
                longest = len(term) + edits if terms is not self.short_stems else 1 << 30
                out |= (missing <= edits + signs) & (alnum <= longest) & (chars >= len(term) - edits)
        return out

    def kind(self, word: str) -> int | None:
        edits = min((e for trie in self.tries if (e := trie.edits_to(word)) is not None), default=None)
        if edits == 0:
            return 0
        node = self.stems
        for letter in word:
            node = node.get(letter) or node.get(LOOK_ALIKES.get(letter))
            if node is None:
                return edits
            if "" in node:
                return 3
        return edits

    def __call__(self, word: str) -> int | None:
        try:
            return self.seen[word]
        except KeyError:
            plain = plain_word(word)
            hit = self.kind(plain) if _LETTERS.search(plain) else None
            if len(self.seen) >= CACHE_WORDS:
                self.seen.clear()
            self.seen[word] = hit
            return hit


_FINDERS: dict[tuple, Finder] = {}


def _finder(lexicon: tuple) -> Finder:
    if lexicon not in _FINDERS:
        _FINDERS.clear()
        _FINDERS[lexicon] = Finder(*map(list, lexicon))
    remember("finders", _FINDERS.clear)
    return _FINDERS[lexicon]


def _column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def _batch_features(text: pa.Array, raw: list[bytes], find: Finder) -> np.ndarray:
    """Features of every text. Each distinct word of the batch is looked up once; only texts with a hit are read again."""
    distinct, index, starts = split_words(text, lower=False)
    hit = find.possible(distinct)
    hit[hit] = [find(w) is not None for w in distinct.filter(pa.array(hit)).to_pylist()]
    sums = np.concatenate([[0], np.cumsum(hit[index])])
    out = np.zeros((len(raw), len(HIT_FEATURES)))
    for i in np.flatnonzero(sums[starts[1:]] > sums[starts[:-1]]).tolist():
        out[i] = hit_features(raw[i].decode(), find)
    return out


def _featured(lexicon: tuple):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = _finder(lexicon)
        for part, raw in batches_of_bytes(batches, uses="finders"):
            x = _batch_features(_column(part, "text"), raw, find)
            yield pa.RecordBatch.from_arrays([_column(part, "label"), pa.array(list(x), pa.list_(pa.float64()))], ["label", "x"])
    return run


def _scored(lexicon: tuple, weights: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = _finder(lexicon)
        for part, raw in batches_of_bytes(batches, uses="finders"):
            x = _batch_features(_column(part, "text"), raw, find)
            score = 1 / (1 + np.exp(-np.clip(weights[0] + x @ weights[1:], -30, 30)))
            yield pa.RecordBatch.from_arrays([_column(part, "doc_id"), _column(part, "held_out"), pa.array(score),
                                              *(pa.array(np.rint(np.expm1(x[:, i])).astype("i8")) for i in range(5))],
                                             ["doc_id", "held_out", "score", *HITS])
    return run


def _lower_bound(toxic, n):
    """95 % lower bound (Wilson) of a share."""
    share, z = toxic / n, F.lit(1.645)
    return (share + z * z / (2 * n) - z * F.sqrt(share * (1 - share) / n + z * z / (4 * n * n))) / (1 + z * z / n)


def _chosen(counted: DataFrame) -> DataFrame:
    bound = _lower_bound(F.col("toxic"), F.col("n"))
    return counted.withColumn("bound", bound).where((F.col("toxic") >= MIN_SUPPORT) & (F.col("bound") >= MIN_SHARE * F.col("toxic") / (F.col("toxic") + 1)))


def _best(counted: DataFrame) -> list[str]:
    return [r["term"] for r in _chosen(counted).orderBy(F.desc("bound"), "term").limit(LEXICON_TERMS).collect()]


def _misspelt(terms: tuple):
    """(word, the term it may be a misspelling of, edits)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tries = [Trie(some, e) for e in (1, 2) if (some := [t for t in terms if allowed_edits(len(t)) == e])]
        for batch in batches:
            found = [(w, *nearest_term(w, trie.root, trie.edits)) for w in batch.column(0).to_pylist() for trie in tries if trie.edits_to(w)]
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], k) for i, k in enumerate((pa.string(), pa.string(), pa.int32()))], ["word", "near", "edits"])
    return run


def learn_lexicon(train: DataFrame) -> tuple[tuple[str, ...], tuple[str, ...], tuple[tuple[str, int], ...]]:
    """Words, stems and the words that allow fewer edits than their length says, from (label_id, label, text).

    Words: of 4 letters or more, toxic by the lower bound of their share of witnesses. A document is a witness of a
    word if most of the word's places in it (word before, word, word after) have not been seen in a document of
    smaller id. Stems: first letters of at least STEM_WORDS words, by the lower bound of the share
    of the documents in which they stand twice or more. A word whose stem is chosen is left to the stem. A word allows only
    the edits within which no more than CLEAN_NEAR of the clean documents hold a word.
    """
    # each word from its first letter to its last
    words = F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}(?:[^\x20\x09-\x0D]*\p{L})?"), F.lit(0))
    split = train.select("label_id", "label", words.alias("w"))
    total = F.sum("label").alias("toxic"), F.count(F.lit(1)).alias("n")

    word = split.select("label_id", "label", F.explode("w").alias("word")).where(F.length("word") >= 4).groupBy("label_id", "label", "word").agg(F.count(F.lit(1)).alias("times"))
    word = staged(word, "labelled-words")
    some = _chosen(word.groupBy(F.col("word").alias("term")).agg(*total)).select("term")
    places = (split.select("label_id", "label", "w", F.explode(F.sequence(F.lit(1), F.size("w"))).alias("i"))
              .select("label_id", "label", F.get("w", F.col("i") - 1).alias("term"), F.get("w", F.col("i") - 2).alias("before"), F.get("w", F.col("i")).alias("after"))
              .join(some, "term").groupBy("term", "before", "after").agg(F.min("label_id").alias("first"), F.collect_set(F.struct("label_id", "label")).alias("seen")))
    witness = (places.select("term", "first", F.inline("seen")).groupBy("term", "label_id", "label")
               .agg(F.avg((F.col("first") == F.col("label_id")).cast("double")).alias("own")).where("own > 0.5"))
    terms = _best(witness.groupBy("term").agg(*total))

    starts = F.array(*(F.when(F.length("word") > k, F.substring("word", 1, k)) for k in STEM_LETTERS))
    stem = word.select("label_id", "label", "word", "times", F.explode(starts).alias("term")).where("term is not null")
    wide = stem.where("label = 1").groupBy("term").agg(F.approx_count_distinct("word").alias("words")).where(F.col("words") >= STEM_WORDS).select("term")
    twice = stem.join(wide, "term").groupBy("term", "label_id", "label").agg(F.sum("times").alias("times")).where("times > 1")
    stems = _best(twice.groupBy("term").agg(*total))
    terms = tuple(t for t in terms if not any(t[:k] in stems for k in STEM_LETTERS))

    clean = word.where("label = 0")
    close = clean.select("word").distinct().mapInArrow(_misspelt(terms), "word string, near string, edits int")
    seen = clean.join(close, "word").groupBy("near").agg(*(F.countDistinct(F.when(F.col("edits") <= e, F.col("label_id"))).alias(f"within_{e}") for e in (1, 2))).collect()
    most = CLEAN_NEAR * split.where("label = 0").count()
    limits = [(r["near"], 0 if r["within_1"] > most else 1) for r in seen if r["within_2"] > most]
    return terms, tuple(stems), tuple(sorted(limits))


def fit(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights (constant first) of a logistic model, drawn to PRIOR as if ``PRIOR_ROWS`` rows spoke for it. No
    weight of a hit falls below zero."""
    if not len(y) or y.min() == y.max():
        return PRIOR.copy()
    z = np.column_stack([np.ones(len(x)), x])
    w = PRIOR.copy()
    pull = np.full(len(w), PRIOR_ROWS)
    pull[0] = 1e-2
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        grad = z.T @ (y - p) - pull * (w - PRIOR)
        step = np.linalg.solve((z * (p * (1 - p) + 1e-9)[:, None]).T @ z + np.diag(pull), grad)
        w += step * min(1.0, 3 / max(np.abs(step).max(), 1e-9))
        if np.abs(step).max() < 1e-8:
            break
    w[1:] = np.maximum(w[1:], 0)
    return w


def toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", rows: int = LABELLED_ROWS // 2, at: float = PREDICTED_AT) -> DataFrame:
    """(doc_id, held_out, score, predicted, hits by kind) of every row of ``docs``.

    Labels of ids whose CRC-32 (as text) leaves 1 modulo 3 are never learned from.
    """
    prepare(docs.sparkSession)

    def fold(c: str):
        return F.coalesce(F.crc32(F.col(c).cast("bigint").cast("string").cast("binary")) % 3 == 1, F.lit(False))

    sample = labelled_sample(labels, label, ~fold("doc_id"), rows)
    own = texts(docs)
    train = own.join(F.broadcast(sample), F.col("doc_id") == F.col("label_id")).select("label_id", "label", "text")
    lexicon = learn_lexicon(train)
    got = train.mapInArrow(_featured(lexicon), "label int, x array<double>").toArrow()
    weights = fit(np.array(got["x"].to_pylist()).reshape(-1, len(HIT_FEATURES)), got["label"].to_numpy().astype("f8"))
    scored = own.withColumn("held_out", fold("doc_id")).mapInArrow(
        _scored(lexicon, weights), "doc_id bigint, held_out boolean, score double, " + ", ".join(f"{h} bigint" for h in HITS))
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= at).cast("int").alias("predicted"), *HITS)
