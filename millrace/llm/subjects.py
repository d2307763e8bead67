"""Subjects of documents: none, one or several of a given list.

Three steps. A text is cut into its running sentences; headings, code and markup are none. Terms (words and
pairs of words) of the sentences get weights by expectation maximisation over the labelled documents: a
document's labels say which subjects its sentences may have, not which sentence has which. The shares of
sentences by subject, the document's structure and its source then go into a chain of logistic classifiers,
one per subject, each of which also sees the subjects decided before it and so models which ones go together.
The chain's scores are calibrated on held-out folds, and a beam search takes the most probable combination.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.languages import FUNCTION_WORDS, by_function_words

#: Labelled documents that the model is fitted on, at most, chosen by a seeded hash; all documents are classified.
MAX_LABELLED = 2_000
#: Terms of the model at most, the most frequent ones of the labelled sentences.
MAX_TERMS = 60_000
ROUNDS, FOLDS, BEAM, L2 = 8, 5, 8, 1.0
#: Sentences of mean behaviour added to every class, and the largest weight of a term.
STIFF, CLIP = 2.0, 4.0
#: A term may tell a subject if at least this part of the labelled documents that hold it have the subject, and chance is ruled out by this gain in log likelihood.
LEAST_PART, LEAST_GAIN = 0.5, 2.5
LANGUAGES = [None, *FUNCTION_WORDS]
#: Share of the sentences from which a subject counts; shares enter the chain relative to it.
SHARE = 0.25

_FENCE = re.compile(r"```.*?(?:```|\Z)", re.S)
_TAG = re.compile(r"</?[A-Za-z][^<>\n]{0,200}>|<!--.*?-->", re.S)
_CODE_BLOCK = re.compile(r"^[ \t]*to(?:-report)?[ \t]+\S+(?:[ \t]*\[[^\]\n]*\])?[ \t]*$.*?^[ \t]*end\b[ \t]*$", re.M | re.S)
_CODE_LINE = re.compile(r"^\s{2,}(?:;|let |set |ask |if |ifelse |diffuse |tick\b|report |while |repeat )|^\s*;")
_ENDS = re.compile(r"[.!?…。？！][\"'”»)\]]*$")
_SPLIT = re.compile(r"(?<=[.!?。])[\"'”»)\]]*\s+(?=\S)")
_IDENT = re.compile(r"`[^`\n]*`?|\b\w+(?:-\w+){2,}\b|\d+")
_MARKED = re.compile(r"[`\d]|-\w+-")
_WORD = re.compile(r"[^\W\d_]+(?:['’-][^\W\d_]+)*")


def running_sentences(text: str | None) -> tuple[list[str], dict[str, float]]:
    """The sentences of the running text, and what the rest looks like."""
    if not text:
        return [], {"code": 0.0, "heading": 0.0, "markup": 0.0, "paragraphs": 0.0}
    t = html.unescape(text).replace("\xa0", " ").replace("\r\n", "\n").replace("\r", "\n")
    bare = _TAG.sub("\n", t)
    seen = {"markup": float(bare != t)}
    plain = _CODE_BLOCK.sub("\n", _FENCE.sub("\n", bare))
    seen["code"] = float(plain != bare)
    out: list[str] = []
    heads = paragraphs = 0
    for line in plain.split("\n"):
        s = line.strip()
        if not s:
            continue
        if s.startswith("#") or (not _ENDS.search(s) and len(s.split()) <= 6):
            heads += 1
            continue
        if _CODE_LINE.match(line):
            continue
        paragraphs += 1
        out += [x for x in _SPLIT.split(s) if _WORD.search(x)]
    return out, seen | {"heading": float(heads > 0), "paragraphs": float(paragraphs)}


def words_in(text: str) -> list[list[str]]:
    """The words of every line, without identifiers and numbers."""
    return [_WORD.findall(_IDENT.sub(" ", x) if _MARKED.search(x) else x) for x in text.lower().replace("’", "'").split("\n")]


def terms(sentence: str) -> list[str]:
    """Words and pairs of neighbouring words, each once."""
    words = words_in(sentence)[0]
    return list(dict.fromkeys(words + [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]))


class Cut:
    """The sentences of documents with their terms as numbers: document, language and number of terms of each sentence, and the terms one after another."""

    def __init__(self, docs: list[list[str]]) -> None:
        code: dict[str, int] = {}
        doc, lang, lens, ids = [], [], [], []
        for i, sentences in enumerate(docs):
            for s in sentences:
                own = terms(s)
                for t in own:
                    ids.append(code.setdefault(t, len(code)))
                doc.append(i)
                lens.append(len(own))
                lang.append(LANGUAGES.index(by_function_words(s)))
        self.names = list(code)
        self.doc, self.lang, self.lens, self.ids = (np.array(x, np.int64) for x in (doc, lang, lens, ids))


class Model:
    """Fitted weights; `subjects` in the order of the chain."""

    def __init__(self, subjects: list[str]) -> None:
        self.subjects = subjects
        self.sources: list[str] = []

    # Sentences

    def fit_terms(self, cut: "Cut", some: np.ndarray, labels: np.ndarray) -> None:
        """cut: the terms of labelled documents; some: which of these are fitted on; labels: one row for each of them."""
        place = np.cumsum(some) - 1
        own = some[cut.doc]
        at = np.repeat(own, cut.lens)
        count = np.bincount(cut.ids[at], minlength=len(cut.names))
        kept = sorted(np.flatnonzero(count > 1).tolist(), key=lambda t: (-count[t], cut.names[t]))[:MAX_TERMS]
        self.vocabulary = {cut.names[t]: i for i, t in enumerate(kept)}
        v, k = len(kept), len(self.subjects)
        self.weights = np.zeros((v, k + 1))
        self._look_up()
        if not own.any():
            self.prior = np.zeros(k + 1)
            return
        code = np.full(len(cut.names), -1)
        code[kept] = np.arange(v)
        known = code[cut.ids[at]]
        sentence = np.repeat(np.arange(own.sum()), cut.lens[own])[known >= 0]
        doc, lang = place[cut.doc[own]], cut.lang[own]
        ids, lens = known[known >= 0], np.bincount(sentence, minlength=own.sum())
        row = np.repeat(np.arange(len(doc)), lens)
        # A term is measured against the sentences of its own languages, so that no subject takes over a language.
        spread = np.bincount(ids * len(LANGUAGES) + lang[row], minlength=v * len(LANGUAGES)).reshape(v, -1).astype(float)
        seen = spread.sum(axis=1, keepdims=True)
        spread /= seen
        mean = seen / (spread @ np.bincount(lang, minlength=len(LANGUAGES)))[:, None]
        # Only terms that stand mostly in documents of one subject may tell subjects apart: the wording that all share gets no weight.
        code = np.sort(doc[row] * np.int64(v) + ids)
        code = code[np.r_[True, code[1:] != code[:-1]]] if len(code) else code
        pairs = np.stack([code // max(v, 1), code % max(v, 1)], axis=1)
        holds = np.bincount(pairs[:, 1], minlength=v).astype(float)
        of = _sums(pairs[:, 1], labels[pairs[:, 0]], v)
        base = np.clip(labels.mean(axis=0), 1e-3, 0.999)
        best = of.argmax(axis=1)
        top = of.max(axis=1)
        second = np.sort(of, axis=1)[:, -2] if k > 1 else np.zeros(v)
        part = np.clip(top / np.maximum(holds, 1), 1e-6, 1 - 1e-6)
        gain = top * np.log(part / base[best]) + (holds - top) * np.log((1 - part) / (1 - base[best]))
        tells = (part >= LEAST_PART) & (gain >= LEAST_GAIN) & (top >= 1.25 * second) & (part > base[best])
        # What a document's labels allow: its subjects, none, and any other as a passing mention.
        allow = np.full((int(some.sum()), k + 1), 0.1 / k)
        allow[:, 0] = 0.4
        allow[:, 1:] += labels * (0.6 / np.maximum(labels.sum(axis=1, keepdims=True), 1))
        prior = np.log(allow / allow.sum(axis=1, keepdims=True))[doc]
        self.weights[tells, 1 + best[tells]] = 3.0
        for last in range(ROUNDS + 1):
            score = prior + _sums(row, self.weights[ids], len(doc))
            p = np.exp(score - score.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            if last == ROUNDS:
                break
            mass = _sums(ids, p[row], v)
            total = _sums(lang, p, len(LANGUAGES))
            rate = np.log((mass + STIFF * mean) / (spread @ total + STIFF))
            self.weights = np.where(tells[:, None], np.clip(rate - rate[:, :1], -CLIP, CLIP), 0.0)
        flat = np.full(k + 1, 0.6 / k)
        flat[0] = 0.4
        self.prior = np.log(flat)
        self._look_up()

    def _look_up(self) -> None:
        """The terms that tell subjects apart, by first word; all others have no weight."""
        used = np.flatnonzero(self.weights.any(axis=1))
        place = {int(v): i for i, v in enumerate(used)}
        self.rows = self.weights[used]
        self.words: dict[str, int] = {}
        self.pairs: dict[str, dict[str, int]] = {}
        for t, v in self.vocabulary.items():
            if v in place:
                first, _, second = t.partition(" ")
                if second:
                    self.pairs.setdefault(first, {})[second] = place[v]
                else:
                    self.words[first] = place[v]

    def _known(self, words: list[str]) -> set[int]:
        own = set(words)
        found = {self.words[w] for w in own & self.words.keys()}
        begin = own & self.pairs.keys()
        if begin:
            for first, second in zip(words, words[1:], strict=False):
                if first in begin and second in self.pairs[first]:
                    found.add(self.pairs[first][second])
        return found

    def sentence_subjects(self, docs: list[list[str]]) -> np.ndarray:
        """(sentences of all documents, 1 + subjects) probabilities, none first."""
        ids: list[int] = []
        lens: list[int] = []
        for sentences in docs:
            if not sentences:
                continue
            for line in words_in("\n".join(sentences)):
                known = self._known(line)
                ids += known
                lens.append(len(known))
        out = np.tile(self.prior, (len(lens), 1))
        if ids:
            out += _sums(np.repeat(np.arange(len(lens)), lens), self.rows[ids], len(lens))
        out = np.exp(out - out.max(axis=1, keepdims=True))
        return out / out.sum(axis=1, keepdims=True)

    # Documents

    def features(self, cut: list[tuple[list[str], dict[str, float]]], sources: list[str | None]) -> np.ndarray:
        """One row per document; cut: what running_sentences gives of each."""
        k = len(self.subjects)
        n = np.array([len(x) for x, _ in cut], np.int64)
        deals = (self.sentence_subjects([x for x, _ in cut]) > 0.5)[:, 1:].astype(float)
        share = _sums(np.repeat(np.arange(len(cut)), n), deals, len(cut)) / np.maximum(n, 1)[:, None]
        top = np.sort(share, axis=1)[:, max(0, k - 3) :].sum(axis=1)
        seen = np.array([[x["code"], x["heading"], x["markup"], np.log1p(x["paragraphs"])] for _, x in cut])
        source = np.array([[float(s == own) for own in self.sources] for s in sources]).reshape(len(cut), len(self.sources))
        return np.concatenate([np.clip((share - SHARE) * 12, -3, 3), (share >= SHARE - 1e-9) * 2.0, np.stack([top, np.log1p(n) / 2, (n == 0).astype(float)], axis=1), seen, source, np.ones((len(cut), 1))], axis=1)

    def _own(self, x: np.ndarray, before: np.ndarray, j: int) -> np.ndarray:
        """What the j-th classifier sees: its subject's share, the strongest other, structure and source, and the subjects decided before it."""
        k = len(self.subjects)
        others = np.delete(x[:, :k], j, axis=1)
        top = others.max(axis=1, keepdims=True) if k > 1 else np.zeros((len(x), 1))
        return np.concatenate([x[:, [j, k + j]] * 1.0, top, x[:, 2 * k :], before], axis=1)

    def fit_chain(self, x: np.ndarray, labels: np.ndarray) -> None:
        k = len(self.subjects)
        self.chain, self.scale = [], []
        fold = np.arange(len(x)) % FOLDS
        for j in range(k):
            z = self._own(x, labels[:, :j], j)
            y = labels[:, j]
            held = np.zeros(len(x))
            for f in range(FOLDS):
                a = fold != f
                held[~a] = z[~a] @ _logistic(z[a], y[a]) if a.any() else 0.0
            self.chain.append(_logistic(z, y))
            two = _logistic(np.stack([held, np.ones(len(held))], axis=1), y, 1e-3)
            self.scale.append(two if np.isfinite(two).all() and two[0] > 0 else np.array([1.0, 0.0]))

    def decode(self, x: np.ndarray) -> np.ndarray:
        """(documents, subjects) of 0 and 1: the most probable combinations that a beam of BEAM finds."""
        k, n = len(self.subjects), len(x)
        beams = np.zeros((n, 1, 0))
        logp = np.zeros((n, 1))
        for j in range(k):
            b = beams.shape[1]
            z = self._own(np.repeat(x, b, axis=0), beams.reshape(n * b, j), j)
            m = (z @ self.chain[j]).reshape(n, b) * self.scale[j][0] + self.scale[j][1]
            yes, no = -np.logaddexp(0, -m), -np.logaddexp(0, m)
            logp = np.concatenate([logp + no, logp + yes], axis=1)
            grown = np.concatenate([np.concatenate([beams, np.full((n, b, 1), v)], axis=2) for v in (0.0, 1.0)], axis=1)
            best = np.argsort(-logp, axis=1, kind="stable")[:, :BEAM]
            logp = np.take_along_axis(logp, best, axis=1)
            beams = np.take_along_axis(grown, best[:, :, None], axis=1)
        return beams[:, 0, :].astype(np.int8)

    def predict(self, texts: list[str | None], sources: list[str | None]) -> np.ndarray:
        if not texts:
            return np.zeros((0, len(self.subjects)), np.int8)
        return self.decode(self.features([running_sentences(t) for t in texts], sources))


def _sums(at: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Sums of rows by their index `at`."""
    if not rows.shape[1]:
        return np.zeros((n, 0))
    return np.stack([np.bincount(at, weights=rows[:, c], minlength=n) for c in range(rows.shape[1])], axis=1)


def _logistic(x: np.ndarray, y: np.ndarray, l2: float = L2) -> np.ndarray:
    """Weights of a logistic regression with a quadratic penalty, by Newton's method."""
    w = np.zeros(x.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - y) + l2 * w
        h = (x * (p * (1 - p))[:, None]).T @ x + (l2 + 1e-6) * np.eye(len(w))
        step = np.linalg.solve(h, g)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit(texts: list[str | None], sources: list[str | None], labels: list[set[str]], subjects: list[str]) -> Model:
    often = {s: sum(s in x for x in labels) for s in subjects}
    model = Model(sorted(subjects, key=lambda s: (-often[s], s)))
    y = np.array([[float(s in x) for s in model.subjects] for x in labels]).reshape(len(labels), len(subjects))
    named = [s for s in sources if s]
    model.sources = sorted({s for s in named if named.count(s) >= 20})
    # Shares of labelled documents must look like those of unseen ones, so each is made by a model that has not seen it.
    cut = [running_sentences(t) for t in texts]
    coded = Cut([x for x, _ in cut])
    fold = np.arange(len(cut)) % FOLDS
    x = np.zeros((len(cut), 2 * len(subjects) + 8 + len(model.sources)))
    for f in range(FOLDS):
        held = np.flatnonzero(fold == f)
        if len(held):
            model.fit_terms(coded, fold != f, y[fold != f])
            x[held] = model.features([cut[i] for i in held], [sources[i] for i in held])
    model.fit_terms(coded, np.ones(len(cut), bool), y)
    model.fit_chain(x, y)
    return model


def labelled_sample(documents: DataFrame, labels: DataFrame, key: str, text: str, source: str, most: int = MAX_LABELLED) -> tuple[list, list, list]:
    """(texts, sources, sets of subjects) of at most `most` labelled documents, the first of a seeded permutation."""
    sets = labels.filter(F.col(key).isNotNull()).groupBy(key).agg(F.collect_set("subject").alias("_subjects"))
    chosen = sets.orderBy(F.xxhash64(F.lit(17), key), key).limit(most)
    rows = documents.select(key, text, source).join(F.broadcast(chosen), key).collect()
    rows.sort(key=lambda r: r[key])
    return [r[text] for r in rows], [r[source] for r in rows], [set(r["_subjects"]) for r in rows]


def subjects_of(documents: DataFrame, labels: DataFrame, subjects: list[str], key: str = "doc_id", text: str = "text", source: str = "source", most: int = MAX_LABELLED) -> DataFrame:
    """(key, subject): one row per document and subject found; documents without a subject have none.

    labels: (key, subject), subject null for a labelled document without one; labels of unknown documents or
    subjects don't count. Null, empty and blank texts have no running text and so no subject. Repeated documents
    give repeated rows. Without any labelled document nothing is found.
    """
    model = fit(*labelled_sample(documents, labels, key, text, source, most), subjects)
    spark = documents.sparkSession
    del model.vocabulary, model.weights  # what tells subjects apart is in the look-up
    sent = spark.sparkContext.broadcast(model)  # at most MAX_TERMS terms with a weight per subject

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for batch in batches:
            found = m.predict(batch.column(1).to_pylist(), batch.column(2).to_pylist())
            at, which = np.nonzero(found)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), pa.array([m.subjects[j] for j in which], pa.string())], [key, "subject"])

    kind = dict(documents.dtypes)[key]
    return documents.select(key, text, source).mapInArrow(run, f"`{key}` {kind}, subject string")
