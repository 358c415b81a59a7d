"""BPE encoding and decoding by per-prefix dynamic programming.

A piece (a pre-token) is encoded without running its merges. For every prefix
the last token of its encoding is unique. It is found among the tokens that
end there, which a suffix-linked matching automaton of the vocabulary lists:
the longest one that fits behind the last token of the shorter prefix, where
two tokens fit if encoding their joined text gives exactly those two. Following
the stored tokens back from the end gives the ids.

Texts are normalised and cut into pieces with Python's Unicode tables where those
can't differ from the tokenizer's: chunks of code points that are assigned there and
don't combine. A chunk with any other is normalised and cut by the tokenizer
file's own library; its pieces are encoded by the dynamic program like all others.

Whitespace-separated chunks recur, so each Python worker keeps one encoder from
task to task, with the ids of the chunks met lately in two dictionaries of
bounded size: a full one becomes the older one, and the older one goes.
"""

from __future__ import annotations

import json
import re
import unicodedata
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Entries of a worker's dictionary of chunks.
REMEMBERED = 300_000

# Fixed values of the tokenizer's format.
WORD_END = "</w>"
WHITE_SPACE = "".join(map(chr, [
    *range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
PIECE = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^" + WHITE_SPACE + r"\p{L}\p{N}]+"

END = chr(0xE000)  # stands for WORD_END inside pieces; bytes never map to it


def byte_letters() -> list[str]:
    """The letter of each byte: printable Latin-1 stands for itself, the other
    bytes take the code points from 256 on in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(256, 512))
    return [chr(b if b in shown else next(spare)) for b in range(256)]


def unsure() -> re.Pattern:
    """Code points whose class, case or place in a normalised text may depend on the
    version of Unicode, or on the order of marks: unassigned, private and combining ones, and
    all beyond the first plane (one range, so that the class stays a table)."""
    category, combining = unicodedata.category, unicodedata.combining
    ranges, start = [], None
    for i in range(0x80, 0x10000):
        odd = category(chr(i)) in ("Cn", "Co", "Cs", "Mn", "Mc", "Me") or combining(chr(i)) > 0
        if odd and start is None:
            start = i
        elif not odd and start is not None:
            ranges.append(f"\\u{start:04x}-\\u{i - 1:04x}")
            start = None
    last = 0x10000 if start is None else start
    return re.compile(f"[{''.join(ranges)}\\U{last:08x}-\\U0010ffff]")


class PrefixEncoder:
    """Exact BPE of single pieces, and texts to ids and back, for one tokenizer file."""

    def __init__(self, path: str):
        import ahocorasick
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.path, self.library, self.unsure = path, None, unsure().search
        model = spec["model"]
        self.letters = byte_letters()
        self.rank = {(self._inner(a), self._inner(b)): k for k, (a, b) in enumerate(
            m.split(" ") if isinstance(m, str) else m for m in model["merges"])}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.name = {i: t for t, i in model["vocab"].items()} | {i: t for t, i in self.special.items()}
        self.pieces = regex.compile(PIECE).findall
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")").split
        self.id, self.text = {}, {}
        automaton = ahocorasick.Automaton()
        for token, i in model["vocab"].items():
            inner = self._inner(token)
            if self._merged(inner) == [inner]:  # others never come out of an encoding
                self.id[inner], self.text[i] = i, inner
                automaton.add_word(inner, (i, len(inner)))
        automaton.make_automaton()
        self.matches = automaton.iter
        self.whole = {t[:-1]: (i,) for t, i in self.id.items() if t[-1] == END and t[:-1].isascii() and t[:-1].isalpha()}
        self.fit: dict[int, bool] = {}
        self.chunks: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}

    @staticmethod
    def _inner(token: str) -> str:
        return token[:-len(WORD_END)] + END if token.endswith(WORD_END) else token

    def _merged(self, piece: str) -> list[str]:
        """The piece by its merges; only for single tokens and pairs of tokens."""
        parts = list(piece)
        if len(parts) > 1 and parts[-1] == END:
            parts[-2:] = [parts[-2] + END]
        rank = self.rank
        while len(parts) > 1:
            best, k = min((rank.get((parts[i], parts[i + 1]), 1 << 30), i) for i in range(len(parts) - 1))
            if best == 1 << 30:
                break
            parts[k:k + 2] = [parts[k] + parts[k + 1]]
        return parts

    def _fits(self, left: int, right: int) -> bool:
        a, b = self.text[left], self.text[right]
        if len(self.fit) > REMEMBERED:
            self.fit.clear()
        self.fit[left << 20 | right] = ok = self._merged(a + b) == [a, b]
        return ok

    def piece_ids(self, piece: str) -> tuple[int, ...]:
        if piece in self.whole:
            return self.whole[piece]
        return self.word_ids(piece + END if piece.isascii() and piece.isalpha() else "".join(
            [self.letters[b] for b in piece.encode()]) + END)

    def word_ids(self, word: str) -> tuple[int, ...]:
        """Ids of a piece in the letters of its bytes, with its end."""
        n, fit = len(word), self.fit
        last, size = [-1] * (n + 1), [0] * (n + 1)  # by prefix length: its last token, that one's length
        done = 0
        for end, (token, length) in self.matches(word):  # longest first at each end
            if done > end:
                continue
            start = end + 1 - length
            if start:
                before = last[start]
                if before < 0:
                    continue
                ok = fit.get(before << 20 | token)
                if ok is None:
                    ok = self._fits(before, token)
                if not ok:
                    continue
            done = end + 1
            last[done], size[done] = token, length
        ids, at = [], n
        while at:
            ids.append(last[at])
            at -= size[at]
        return tuple(ids[::-1])

    def _chunk(self, chunk: str) -> tuple[int, ...]:
        """Ids of a chunk without white space; a word and one mark behind it share the word's."""
        if len(self.chunks) > REMEMBERED:
            self.chunks, self.older = {}, self.chunks
        known = self.chunks
        if got := self.older.get(chunk):
            pass
        elif chunk.isalpha():
            got = self.piece_ids(chunk)
        elif chunk[-1] in ".,;:!?" and chunk[:-1].isalpha():
            word = chunk[:-1]
            got = (known.get(word) or self._chunk(word)) + (known.get(chunk[-1]) or self.piece_ids(chunk[-1]))
        else:
            got = tuple([i for piece in self.pieces(chunk) for i in self.piece_ids(piece)])
        known[chunk] = got
        return got

    def _own(self, chunk: str) -> tuple[int, ...]:
        """Ids of a chunk, normalised and cut by the tokenizer's library."""
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_file(self.path)
        pieces = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(chunk))
        return tuple([i for piece, _ in pieces for i in self.word_ids(piece + END)])

    def _plain(self, text: str) -> list[int]:
        if not text.isascii() and self.unsure(text):
            # Chunk by chunk: white space ends every composition.
            return [i for chunk in self.words(text) for i in (self._own(chunk) if self.unsure(chunk) else self._sure(chunk))]
        return self._sure(text)

    def words(self, text: str) -> list[str]:
        if any(c in text for c in "\x1c\x1d\x1e\x1f"):  # split() would take them for white space
            import regex
            return [w for w in regex.split(f"[{WHITE_SPACE}]+", text) if w]
        return text.split()

    def _sure(self, text: str) -> list[int]:
        if not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        # Letter by letter: a final sigma is no special case.
        text = text.lower() if "Σ" not in text else "".join([c.lower() for c in text])
        known, chunk = self.chunks.get, self._chunk
        return list(chain.from_iterable([known(w) or chunk(w) for w in self.words(text)]))

    def encode(self, text: str) -> list[int]:
        if "<|" not in text:
            return self._plain(text)
        out = []
        for part in self.cut(text):
            i = self.special.get(part)
            out += self._plain(part) if i is None else [i]
        return out

    def decode(self, ids: list[int]) -> str:
        """The file has no decoder: tokens are joined by a space."""
        name = self.name
        return " ".join([name[i] for i in ids])


def _coder(path: str, kept):
    def run(batches):
        # A broadcast's value lives as long as the worker: the encoder is built once there.
        coder = kept.value.get(path) or kept.value.setdefault(path, PrefixEncoder(path))
        for batch in batches:
            ids, ends, decoded = [], [0], []
            for text in batch.column("text").to_pylist():
                mine = coder.encode(text)
                ids.append(np.array(mine, np.int32))
                ends.append(ends[-1] + len(mine))
                decoded.append(coder.decode(mine))
            flat = pa.array(np.concatenate([*ids, np.empty(0, np.int32)]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat),
                 pa.array(decoded, pa.string())], ["_id", "ids", "decoded"])
    return run


def encode_decode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """One row per input row: ``id_col``, ``ids`` (array<int>), ``decoded``.

    Ids are those of the tokenizer file without added special tokens; special
    strings inside a text become their ids, as the library's default does. The
    file has no decoder, so the decoded text is the tokens joined by a space.
    Null and empty texts give no id and an empty decoded text. Repeated rows
    come out as often as they came in. Other columns are not read.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    kept = docs.sparkSession.sparkContext.broadcast({})
    return docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).mapInArrow(
        _coder(tokenizer_path, kept), f"_id {kind}, ids array<int>, decoded string").withColumnRenamed("_id", id_col)
