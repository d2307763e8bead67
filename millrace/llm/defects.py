"""Defective pairs of question and answer, each with its defect.

Copies are found by compression: question and answer are each compressed with the other as zstandard
dictionary, and where neither leaves anything new but a frame, the answer is the question. Refusals are told
by dictionaries of words, languages by scripts, function words and profiles of trigrams. Whether a text breaks
off is told by its open structure (JSON, code blocks, brackets, list entries) and by a model of terminal
contexts: how often, in all answers, a sentence or entry is over after the tokens that this text ends with.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice, repeat

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.languages import _WEIGHT, language_of
from millrace.llm.refusals import is_refusal

DEFECTS = ("empty", "refusal", "copied_question", "truncated", "other_language")

# What stands for no answer, without marks and in lower case.
PLACEHOLDERS = set("none|null|nil|nan|n a|na|tbd|todo|empty|no answer|no response|no reply|not available|not applicable|answer|response|reply|antwort|keine antwort|leer|k a|respuesta|sin respuesta|vacío|ninguna|réponse|sans réponse|aucune réponse|vide|undefined|unknown|placeholder|xxx|lorem ipsum".split("|"))

#: Bytes that may be left over, beyond the mark and header of a frame, where one text is compressed with the other as dictionary: a frame like "You asked:" and altered marks.
FRAME_BYTES, FRAME_SHARE = 24, 0.22
#: Of the shorter text's own compressed size, the share that may be altered in a copy. Repetitive texts have a small one, however long they are.
ALTERED_SHARE = 0.1
#: Letters of words that the question has not, for each byte they pack to, at most: no text of different words packs closer.
LEAST_PACKED = 5
#: Below this share of endings even a full stop does not count as one.
RARE = 0.1
_FULL_STOP = re.compile(r"[.!?。！？][\"'”»)\]]*$")
_TAG = re.compile(r"</?[A-Za-z][\w-]*\s*/?>")
_WORDS = re.compile(r"[^\W_]+(?:'[^\W_]+)?")
_LONGEST_PLACEHOLDER = max(len(p.split()) for p in PLACEHOLDERS)
_LIST = re.compile(r"^\s*(?:[-*+•]|\d+[.)])(?=\s|$)")


def _is_nothing(text: str) -> bool:
    t = _TAG.sub(" ", text) if "<" in text else text
    first = [m.group().lower() for m in islice(_WORDS.finditer(t), _LONGEST_PLACEHOLDER + 1)]
    return not first or " ".join(first) in PLACEHOLDERS


def _from_json(text: str):
    """(state, value): state is none (no JSON text), broken, or whole."""
    t = text.strip()
    if not t or t[0] not in "{[" or (t[0] == "[" and not re.match(r'\[\s*["\]{\d]', t)) or (t[0] == "{" and not re.match(r'\{\s*["}]', t) and len(t) > 1):
        return "none", None
    try:
        return "whole", json.loads(t)
    except ValueError:
        return "broken", None


def _plain(text: str) -> bytes:
    return " ".join(_WORDS.findall(text.lower())).encode()


def novelty(text: bytes, known: bytes) -> int:
    """Bytes that zstandard needs for text with known as dictionary, without the frame's own."""
    if len(known) < 8:
        return len(text)
    return _packed(text, zstandard.ZstdCompressionDict(known, dict_type=zstandard.DICT_TYPE_RAWCONTENT))


def _packed(text: bytes, d: zstandard.ZstdCompressionDict | None = None) -> int:
    out = zstandard.ZstdCompressor(level=6, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False).compress(text)
    return len(out) - 6 - 3


def is_copy(question: str, answer: str) -> bool:
    q, a = _plain(question), _plain(answer)
    if len(q) < 12 or len(a) < 12:
        return q == a and len(q) > 0
    bound = FRAME_BYTES + FRAME_SHARE * min(len(q), 200) * 0.25
    most = max(bound, FRAME_BYTES + ALTERED_SHARE * min(len(q), len(a)))  # no text packs to more than its bytes
    if sum(map(len, set(a.split()).difference(q.split()))) > LEAST_PACKED * most:
        return False
    new = novelty(a, q)
    if new > most:
        return False
    new = max(new, novelty(q, a))
    return new <= bound or new <= FRAME_BYTES + ALTERED_SHARE * min(_packed(q), _packed(a))


_TOKEN = re.compile(r"`[^`\n]*`|[^\W\d_]+(?:['’][^\W\d_]+)*|\d+(?:[.,]\d+)*|\n|[^\w\s]")
_FENCED = re.compile(r"```.*?(?:```|$)", re.S)
#: Marks with a shape of their own; all others share one, so that the shapes are a closed set whatever the texts hold.
MARKS = set("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~…–—•¿¡“”„«»’‘。！？、，")
_ENDING_MARKS = set(".!?)\"")
_BEGINNINGS = set("`\"'(¿")


@lru_cache(65536)
def _shape_of_word(token: str) -> str:
    low = token.lower()
    return low if low in _WEIGHT else "w"


def _shape(token: str) -> str:
    c = token[0]
    if c == "`" and len(token) > 1:
        return "ID"
    if c.isalpha():
        return _shape_of_word(token)
    if c.isdigit():
        return "N"
    return token if token in MARKS else "m"


def _line_shapes(line: str) -> tuple[str, list[str], list[str]]:
    item = _LIST.match(line)
    tokens = _TOKEN.findall(line[item.end() :] if item else line)
    return "list" if item else "line", tokens, [_shape(t) for t in tokens]


def contexts(text: str) -> tuple[list[tuple[str, str, str]], list[tuple[str, str, str]]]:
    """(contexts after every token of the running text, those of them after which a sentence or entry is over).

    A context is the kind of line and the shapes of the last two tokens. A sentence is over before a line's end
    or before a new sentence that begins with a capital after . ! ? : and what closes them.
    """
    seen, over = [], []
    for line in (_FENCED.sub("\n", text) if "```" in text else text).split("\n"):
        kind, tokens, shapes = _line_shapes(line)
        if not shapes:
            continue
        own = list(zip(repeat(kind), ["^", *shapes], shapes, strict=False))
        seen += own
        over += [own[k] for k in range(len(own) - 1) if shapes[k] in _ENDING_MARKS and (tokens[k + 1][0].isupper() or tokens[k + 1][0] in _BEGINNINGS)]
        over.append(own[-1])
    return seen, over


class Endings:
    """Share of all occurrences of a context at which a sentence or entry is over, backing off to the last token alone."""

    def __init__(self, counts: list[tuple[str, str, str, int, int]]) -> None:
        self.full = {(kind, before, s): (n, over) for kind, before, s, n, over in counts}
        self.last: dict[tuple[str, str], list[int]] = {}
        for kind, _, s, n, over in counts:
            x = self.last.setdefault((kind, s), [0, 0])
            x[0] += n
            x[1] += over

    def over(self, text: str) -> float:
        for line in reversed(_FENCED.sub("\n", text).split("\n")):
            kind, _, shapes = _line_shapes(line)
            if shapes:
                break
        else:
            return 1.0
        n1, o1 = self.last.get((kind, shapes[-1]), (0, 0))
        back = (o1 + 0.5) / (n1 + 1)
        n2, o2 = self.full.get((kind, shapes[-2] if len(shapes) > 1 else "^", shapes[-1]), (0, 0))
        return (o2 + 4 * back) / (n2 + 4)


def count_endings(answers: DataFrame) -> list[tuple[str, str, str, int, int]]:
    """Counts of contexts over all whole texts (one string column); each text's own last token is left out, since it may be cut there.

    Shapes are a closed set of function words, marks and three kinds, so there are never more contexts than
    twice the square of their number (some 200,000), whatever the corpus; all of them are kept.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: Counter = Counter()
        over: Counter = Counter()
        for batch in batches:
            for t in batch.column(0).to_pylist():
                if t:
                    seen, ends = contexts(t)
                    n.update(seen[:-1])
                    over.update(ends[:-1])
        keys = list(n)
        columns = [pa.array([k[i] for k in keys], pa.string()) for i in range(3)]
        yield pa.RecordBatch.from_arrays([*columns, pa.array([n[k] for k in keys], pa.int64()), pa.array([over[k] for k in keys], pa.int64())], ["kind", "before", "last", "n", "over"])

    got = answers.mapInArrow(run, "kind string, before string, last string, n long, over long").groupBy("kind", "before", "last").agg(F.sum("n").alias("n"), F.sum("over").alias("over"))
    return sorted(tuple(r) for r in got.collect())


_BRACKETS = re.compile(r"[()\[\]{}]")
_CODE = re.compile(r"`[^`\n]*`")


def _open_brackets(text: str) -> bool:
    depth = Counter(_BRACKETS.findall(_CODE.sub("", text)))
    return depth["("] > depth[")"] or depth["["] > depth["]"] or depth["{"] > depth["}"]


def is_truncated(text: str, endings: Endings) -> bool:
    t = text.rstrip()
    if t.count("```") % 2:
        return True
    if t.endswith("```"):
        return False
    prose = re.sub(r"```.*?```", "\n", t, flags=re.S).rstrip() if "```" in t else t
    line = prose.split("\n")[-1]
    item = _LIST.match(line)
    if item and not line[item.end() :].strip():
        return True  # a marker without its entry
    if _open_brackets(prose) or line.count("`") % 2:
        return True
    if len(list(islice(_TOKEN.finditer(prose), 4))) <= 3 and "\n" not in prose and prose[-1] not in ",;:–-…":
        return False  # a short answer needs no full stop
    if unicodedata.category(prose[-1]) in ("Pd", "Sm") or prose[-1] in ",;:…" or prose.endswith("..."):
        return True
    return endings.over(prose) < (RARE if _FULL_STOP.search(prose) else 0.5)


def defect_of(question: str | None, answer: str | None, endings: Endings) -> str | None:
    """The defect of a pair, null for a sound one; the first of DEFECTS that fits."""
    if answer is None or _is_nothing(answer):
        return "empty"
    text = answer
    state, value = _from_json(answer)
    if state == "whole" and isinstance(value, dict):
        if value.get("skip") or str(value.get("action", "")).lower() in ("skip", "skipped", "decline", "refuse"):
            return "refusal"
        if "answer" in value:
            text = value["answer"] if isinstance(value["answer"], str) else json.dumps(value["answer"])
            if _is_nothing(text):
                return "empty"
    if is_refusal(text, question):
        return "refusal"
    if question and is_copy(question, text):
        return "copied_question"
    if state == "broken" or is_truncated(text, endings):
        return "truncated"
    if question:
        a, b = language_of(question), language_of(text)
        if a and b and a != b:
            return "other_language"
    return None


def find_defects(pairs: DataFrame, key: str, question: str, answer: str, more_answers: DataFrame | None = None) -> DataFrame:
    """(key, defect) of the defective pairs; every pair has at most one defect.

    Null and blank answers are empty; with a null or blank question an answer is no copy and in no other
    language. Repeated rows give repeated results. more_answers: further texts (one column) for the model of
    terminal contexts. An empty table gives no rows; other columns are dropped.
    """
    texts = pairs.select(F.col(f"`{answer}`").alias("t"))
    if more_answers is not None:
        texts = texts.unionByName(more_answers.toDF("t"))
    counts = count_endings(texts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        endings = Endings(counts)
        for batch in batches:
            found = [defect_of(q, a, endings) for q, a in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            hit = pa.array([x is not None for x in found])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], [key, "defect"]).filter(hit)

    kind = dict(pairs.dtypes)[key]
    return pairs.select(key, question, answer).mapInArrow(run, f"`{key}` {kind}, defect string")
