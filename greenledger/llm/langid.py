"""Language identification by cross-parsing entropy.

For each language a suffix automaton holds a sample of labelled text. A text is
cross-parsed against each: read greedily into the longest phrases that occur in
the sample. Fewer phrases mean a closer language; c phrases over a sample of N
letters cost c * log2(N) bits, and the language with the fewest bits per letter
wins.

Texts are lower-cased, and every run of other characters than letters counts as
one space. The automata become one transition table (state, letter) -> state
with a mark where a phrase ends, so a task steps all texts of a batch through
all languages at once with array lookups. Long texts are parsed in blocks of
``BLOCK`` letters; a phrase ends with its block.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLOCK = 4096
#: The labelled sample, by default: at most so many texts of a language, so many characters of each.
SAMPLE_TEXTS = 64
SAMPLE_CHARS = 400
#: The model holds one automaton per label, so labels are bounded; more raise an error.
MAX_LANGUAGES = 500
#: Letters that one step of the parser holds in memory.
STEP_LETTERS = 1 << 24
UNKNOWN = "und"


def held_out(id_col: str = "doc_id") -> F.Column:
    """True for the fold that is never learned from (a null id is not in it)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 3 == 1


def labelled_sample(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                    texts: int = SAMPLE_TEXTS, chars: int = SAMPLE_CHARS) -> dict[str, list[str]]:
    """{language: texts}: of each label the ``texts`` distinct texts with the smallest
    hashes outside the held-out fold, ``chars`` characters of each from a hashed offset on.

    Copies count once, so a group of them doesn't fill a language's sample, and a
    shared head or licence at the top of many texts isn't what is learned.
    """
    known = docs.filter(~held_out(id_col) & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    known = known.select(F.col(lang_col).alias("lang"), F.xxhash64(text_col).alias("h"), F.col(text_col).alias("t"))
    first = Window.partitionBy("lang").orderBy("h")
    # Hashes only, copies merged in the tasks. Each task passes on ``texts`` rows per label.
    bound = (known.select("lang", "h").distinct().withColumn("k", F.row_number().over(first))
             .filter(F.col("k") <= texts).groupBy("lang").agg(F.max("h").alias("most")))
    got = bound.limit(MAX_LANGUAGES + 1).collect()
    if len(got) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} language labels")
    if not got:
        return {}
    near = F.lit(False)
    for r in got:
        near = near | ((F.col("lang") == r["lang"]) & (F.col("h") <= r["most"]))
    start = F.pmod(F.xxhash64("h"), F.greatest(F.char_length("t") - chars + 1, F.lit(1))) + 1
    rows = known.filter(near).select("lang", "h", F.substring("t", start.cast("int"), F.lit(chars)).alias("t")).groupBy("lang", "h").agg(
        F.min("t").alias("t")).collect()
    sample: dict[str, list[str]] = {}
    for r in sorted(rows, key=lambda r: (r["lang"], r["h"], r["t"])):
        sample.setdefault(r["lang"], []).append(r["t"])
    return sample


def letters_only(text: str) -> str:
    """Lower case; one space for every run of non-letters, none at the ends."""
    return " ".join("".join([c if c.isalpha() else " " for c in text.lower()]).split())


def suffix_automaton(text: str) -> list[dict[str, int]]:
    """Transitions of the minimal automaton of all substrings of ``text``."""
    nxt, link, length, last = [{}], [-1], [0], 0
    for c in text:
        cur = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p != -1 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p != -1:
            q = nxt[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                clone = len(nxt)
                nxt.append(dict(nxt[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                link[q] = link[cur] = clone
                while p != -1 and nxt[p].get(c) == q:
                    nxt[p][c] = clone
                    p = link[p]
        last = cur
    return nxt


class Parser:
    """Phrase counts of texts against the samples of all languages."""

    def __init__(self, sample: dict[str, list[str]]):
        texts = {lang: letters_only(" ".join(parts)) for lang, parts in sorted(sample.items())}
        texts = {lang: t for lang, t in texts.items() if t}
        self.langs = list(texts)
        alphabet = sorted({c for t in texts.values() for c in t} - {" "})
        code = {" ": 0} | {c: k + 1 for k, c in enumerate(alphabet)}
        self.size = size = len(code) + 1  # the last code: letters of no sample
        self.codes = np.fromiter((size - 1 if chr(c).isalpha() else 0 for c in range(0x110000)), np.int16, 0x110000)
        for c, k in code.items():
            self.codes[ord(c)] = k
        self.bits = np.array([math.log2(len(t) + 1) for t in texts.values()])
        tables, self.roots, at = [], [], 0
        for t in texts.values():
            states = suffix_automaton(t)
            lost = len(states)  # inside a phrase that is one unknown letter
            table = np.empty((lost + 1, size), np.int64)
            begin = np.full(size, lost, np.int64)
            for c, q in states[0].items():
                begin[code[c]] = q
            table[:] = (begin + at) * size << 1 | 1  # a phrase ends, the next begins
            table[0] -= 1  # from the root nothing ends
            for s, moves in enumerate(states):
                for c, q in moves.items():
                    table[s, code[c]] = (q + at) * size << 1
            tables.append(table)
            self.roots.append(at * size)
            at += lost + 1
        self.table = np.concatenate(tables).ravel() if tables else np.empty(0, np.int64)
        if len(self.table) < 1 << 30:
            self.table = self.table.astype(np.int32)

    @classmethod
    def restored(cls, state: dict) -> Parser:
        parser = cls.__new__(cls)
        parser.__dict__.update(state)
        return parser

    def letters(self, text: str | None) -> np.ndarray:
        """Codes of the normalised text, without spaces at the ends."""
        c = self.codes[np.frombuffer((text or "").lower().encode("utf-32-le"), "<u4")]
        space = c == 0
        keep = ~space
        keep[1:] |= ~space[:-1]  # of a run of spaces the first stays, if a letter is before it
        c = c[keep]
        return c[:-1] if len(c) and c[-1] == 0 else c

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """(text, language) -> number of phrases."""
        owner, blocks = [], []
        for k, x in enumerate(texts):
            for at in range(0, len(x), BLOCK):
                owner.append(k)
                blocks.append(x[at:at + BLOCK])
        out = np.zeros((len(texts), len(self.langs)), np.int64)
        lengths = np.array([len(b) for b in blocks], np.int64)
        order = np.argsort(-lengths, kind="stable")
        owner = np.array(owner, np.int64)
        per = max(1, STEP_LETTERS // BLOCK)
        for lo in range(0, len(order), per):
            mine = order[lo:lo + per]
            size = lengths[mine]
            grid = np.zeros((size[0], len(mine)), np.int16)
            for j, b in enumerate(mine):
                grid[:size[j], j] = blocks[b]
            active = np.searchsorted(-size, -np.arange(size[0]), "left")  # blocks longer than t
            state = np.repeat(np.array(self.roots, self.table.dtype)[:, None], len(mine), 1)
            count = np.ones(state.shape, np.int32)  # the phrase that the end closes
            for t in range(size[0]):
                n = active[t]
                step = self.table.take(state[:, :n] + grid[t, :n])
                count[:, :n] += step & 1
                state[:, :n] = step >> 1
            np.add.at(out, owner[mine], count.T)
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        letters = [self.letters(t) for t in texts]
        if not self.langs:
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        cost = self.phrases(letters) * self.bits
        best = cost.argmin(1)
        ranked = np.sort(cost, 1)
        second = ranked[:, 1] if len(self.langs) > 1 else np.full(len(texts), np.inf)
        with np.errstate(invalid="ignore", divide="ignore"):
            score = 1 - ranked[:, 0] / second
        langs = [self.langs[b] if len(x) else UNKNOWN for b, x in zip(best, letters)]
        return langs, [float(s) if len(x) else 0.0 for s, x in zip(score, letters)]


def _labeller(model, text_col: str, columns: list[str]):
    def run(batches):
        parser = Parser.restored(model.value)
        for batch in batches:
            langs, scores = parser.predict(batch.column(text_col).to_pylist())
            kept = batch.select(columns)
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                [*columns, "lang_pred", "score"])
    return run


def identify(docs: DataFrame, sample: dict[str, list[str]], text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, from the text alone.

    ``score`` is 1 - cost of the best / cost of the second-best language: 0 for
    a tie (the first name wins), 1 if only one language is known. A null text or
    one without a letter is ``und`` with score 0, and so is every text if nothing
    was learned. Columns named ``lang_pred`` or ``score`` are replaced; all
    others, and repeated rows, come through unchanged.
    """
    columns = [c for c in docs.columns if c.lower() not in ("lang_pred", "score")]
    schema = T.StructType([*[docs.schema[c] for c in columns], T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType())])
    # Bounded by the sample: some 50 bytes x alphabet per sampled letter.
    model = docs.sparkSession.sparkContext.broadcast(vars(Parser(sample)))
    return docs.select(*columns).mapInArrow(_labeller(model, text_col, columns), schema)
