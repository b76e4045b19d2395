"""SentencePiece encoding and decoding by streaming Viterbi.

A lattice runs over the characters of the normalised text; a node is a
position, an arc a piece of the vocabulary (or one unknown character). Nodes
are settled from left to right, each from the arcs that end there, which reach
back one maximum piece length at most. When the backpointers of all nodes that
later arcs can still leave from meet at one boundary, the ids before it are
committed and the lattice before it is forgotten.

* Unigram models: a path's score is the sum of its pieces' scores, and a
  node keeps its best path.
* BPE models: scores are merge ranks, and the path with the best sum is not
  what the model means. A segmentation is the model's own exactly if each
  pair of neighbours, merged on its own, stays those two pieces (merges across
  a boundary would also happen there). So the arcs of a node are allowed
  only where the pair test holds with the arc before them; one arc of each
  node passes, the same as the last piece of the encoded prefix.

Where two neighbouring characters stand side by side in no piece (a letter and
the blank after it, say), every path has a boundary, so paths always meet. The
text is cut there, and the ids of short stretches are kept in a bounded table.

Defined results
* Null and empty texts have no ids; no ids (or null) decode to the empty text.
* U+2581 in a text stands for a blank, as in the model; such a text does not
  come back as it was. Unknown characters become byte pieces.
* Rows that repeat each other are separate rows. Input columns are carried
  along; ``ids``, ``n_ids`` and ``decoded`` of the input are replaced.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Sequence
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import slices, with_fields

BLANK = "▁"
NEVER = float("-inf")
SLICE_BYTES = 2 << 20  # text encoded at a time
KEEP_CHARS = 64        # longer stretches are encoded each time
KEEP_ENTRIES = 300_000  # stretches per generation and Python worker (two take about 120 MB)
KEEP_PAIRS = 1 << 18    # pair tests kept (about 25 MB)


class Vocabulary:
    """Pieces, scores and byte pieces of a model file, read once per worker."""

    def __init__(self, model: bytes) -> None:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = sp.get_piece_size()
        pieces = [sp.id_to_piece(i) for i in range(n)]
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i) for i in range(n)]
        self.pieces = pieces
        self.weights = [sp.get_score(i) for i in range(n)]
        self.scores = {p: self.weights[i] for i, p in enumerate(pieces) if not special[i]}
        finder = ahocorasick.Automaton()
        for i, p in enumerate(pieces):
            if not special[i]:
                finder.add_word(p, (i, len(p)))
        finder.make_automaton()
        self.arcs = finder.iter
        self.bytes = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)] if any(map(sp.is_byte, range(n))) else None
        self.longest = max(map(len, self.scores), default=1)
        self.bpe = model_type(model) == 2
        values = [p.replace(BLANK, " ").encode() for p in pieces]
        for b, i in enumerate(self.bytes or ()):
            values[i] = bytes([b])
        for i in range(n):
            if sp.is_control(i):
                values[i] = b""
            elif sp.is_unknown(i):
                values[i] = " ⁇ ".encode()
        self.values = values
        # characters side by side in some piece: between any others, paths always meet
        self.characters = frozenset(p for p in self.scores if len(p) == 1)
        self.inside = {p[i:i + 2] for p in self.scores for i in range(len(p) - 1)}
        loose = not any("\n" in x or x[1] == BLANK != x[0] for x in self.inside)
        self.cut = re.compile(r" *[^ \n]+| +|\n") if loose else None
        if self.bytes is None or any(c not in self.scores for p in self.scores for c in p):
            raise ValueError("models without byte pieces, or without a piece for each character of a piece, are not covered")
        if sp.normalize("A  ﬁ ½\tb ") != f"{BLANK}A{BLANK}{BLANK}ﬁ{BLANK}½\tb{BLANK}":
            raise ValueError("models with a normaliser of their own, or without the leading blank, are not covered")

    def bytes_of(self, character: str) -> list[int]:
        return [self.bytes[b] for b in character.encode()]


def model_type(model: bytes) -> int:
    """``trainer_spec.model_type`` of a serialised model: 1 unigram, 2 BPE."""

    def fields(data: bytes):
        at = 0
        while at < len(data):
            tag, at = varint(data, at)
            if tag & 7 == 0:
                value, at = varint(data, at)
            else:
                size, at = varint(data, at) if tag & 7 == 2 else ({1: 8, 5: 4}[tag & 7], at)
                value, at = data[at:at + size], at + size
            yield tag >> 3, value

    def varint(data: bytes, at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            b = data[at]
            value, shift, at = value | (b & 127) << shift, shift + 7, at + 1
            if b < 128:
                return value, at

    kinds = [v for k, spec in fields(model) if k == 2 for f, v in fields(spec) if f == 3]
    return kinds[-1] if kinds else 1


class Viterbi:
    """Encodes normalised text of known characters, fed in pieces; holds the
    part that is not committed."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.v = vocabulary
        self.built: dict[int, tuple] = {}  # at most one entry per piece
        self.pairs: dict[int, bool] = {}
        self.reset()

    def reset(self) -> None:
        # node j: positions count from the last commit; the arc into it is the piece into[j], from back[j]
        self.text, self.back, self.into, self.best = "", [0], [-1], [0.0]

    def _merges(self, piece: int) -> tuple[bool, list[float], list[str], list[str]]:
        """How the model builds a piece from its characters: whether it comes
        out whole, the score of each merge (then -inf), and the first and the
        last part before each."""
        if piece in self.built:
            return self.built[piece]
        parts, scores, table = list(self.v.pieces[piece]), [], self.v.scores
        first, last = [parts[0]], [parts[-1]]
        while len(parts) > 1:
            joined = [(-table[p], i) for i in range(len(parts) - 1) if (p := parts[i] + parts[i + 1]) in table]
            if not joined:
                break
            score, i = min(joined)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            scores.append(-score)
            first.append(parts[0])
            last.append(parts[-1])
        self.built[piece] = len(parts) == 1, [*scores, NEVER], first, last
        return self.built[piece]

    def _stays(self, left: int, right: int) -> bool:
        """Whether the model leaves two pieces apart when it encodes them
        alone (``left`` -1: none). Merges go by score, then from the left;
        until one crosses the boundary, each side is built as if it stood
        alone."""
        whole, next_b, first, _ = self._merges(right)
        if left < 0 or not whole:
            return whole
        whole, next_a, _, last = self._merges(left)
        if not whole:
            return False
        table, i, j = self.v.scores, 0, 0
        while True:
            across, a, b = table.get(last[i] + first[j]), next_a[i], next_b[j]
            if across is not None and across > a and across >= b:
                return False
            if a == b == NEVER:
                return True
            if a >= b:
                i += 1
            else:
                j += 1

    def _settle(self) -> None:
        """Settle the nodes of the text that has come in."""
        v, back, into, best, pairs = self.v, self.back, self.into, self.best, self.pairs
        done, bpe = len(back) - 1, v.bpe
        more = len(self.text) - done
        back += [-1] * more
        into += [-1] * more
        skip = max(0, done - v.longest + 1)
        if not bpe:
            best += [0.0] * more
        for end, (piece, length) in v.arcs(self.text[skip:] if skip else self.text):  # by end, the longest first
            j = end + skip + 1
            if j <= done:
                continue
            i = j - length
            if bpe:
                if back[j] < 0:
                    key = into[i] << 32 | piece
                    stays = pairs.get(key)
                    if stays is None:
                        if len(pairs) >= KEEP_PAIRS:
                            pairs.clear()
                        stays = pairs[key] = self._stays(into[i], piece)
                    if stays:
                        back[j], into[j] = i, piece
            elif i >= 0 and (back[j] < 0 or best[i] + v.weights[piece] > best[j]):
                back[j], into[j], best[j] = i, piece, best[i] + v.weights[piece]

    def _take(self, upto: int) -> list[int]:
        out, back, into, j = [], self.back, self.into, upto
        while j:
            if back[j] < 0:
                raise ValueError("a character without a piece")
            out.append(into[j])
            j = back[j]
        out.reverse()
        return out

    def _forget(self, upto: int) -> None:
        self.text = self.text[upto:]
        self.back = [0, *(b - upto for b in self.back[upto + 1:])]
        self.into = self.into[upto:]  # the first one is still the piece before
        self.best = [s - self.best[upto] for s in self.best[upto:]]

    def _meeting(self) -> int:
        """The last boundary that the paths of all nodes share which arcs to
        come may leave from (the last ones, as far as a piece reaches)."""
        end = len(self.back) - 1
        open_nodes = set(range(max(0, end - self.v.longest + 1), end + 1))
        while len(open_nodes) > 1:
            last = max(open_nodes)
            open_nodes.remove(last)
            open_nodes.add(self.back[last])
        return open_nodes.pop()

    def feed(self, text: str) -> list[int]:
        out: list[int] = []
        step = 4 * self.v.longest
        for i in range(0, len(text), step):
            self.text += text[i:i + step]
            self._settle()
            if meeting := self._meeting():
                out += self._take(meeting)
                self._forget(meeting)
        return out

    def finish(self) -> list[int]:
        out = self._take(len(self.text))
        self.reset()
        return out

    def encode(self, text: str) -> list[int]:
        if len(text) > 4 * self.v.longest:
            return self.feed(text) + self.finish()
        self.text = text
        self._settle()
        return self.finish()


class Encoder(dict):
    """Whole texts to ids (int32 bytes). As a dict: ids of short stretches;
    the ones of the generation before are kept until this one is full too."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        super().__init__()
        self.v, self.viterbi, self.older = vocabulary, Viterbi(vocabulary), {}

    def __missing__(self, stretch: str) -> bytes:
        ids = self.older.get(stretch)
        if ids is None:
            text, inside = stretch.replace(" ", BLANK), self.v.inside
            if len(text) > 2 and text[-2:] not in inside and text[-3:-1] in inside:  # a word and its mark, mostly
                ids = self[stretch[:-1]] + self[stretch[-1:]]
            elif self.v.characters.issuperset(text):
                ids = array("i", self.viterbi.encode(text)).tobytes()
            elif len(text) == 1:
                ids = array("i", self.v.bytes_of(text)).tobytes()
            else:
                cuts = [i for i in range(1, len(text)) if text[i - 1:i + 1] not in inside]
                ids = b"".join([self[stretch[i:j]] for i, j in zip([0, *cuts], [*cuts, len(text)])])
        if len(stretch) <= KEEP_CHARS:
            if len(self) >= KEEP_ENTRIES:
                self.older = dict(self)
                self.clear()
            self[stretch] = ids
        return ids

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        text = " " + text.replace(BLANK, " ")
        return b"".join(map(self.__getitem__, self.v.cut.findall(text))) if self.v.cut else self[text]


def decode_ids(ids: list[int], values: list[bytes]) -> str:
    """The text of the ids, without the blank that stands before each text."""
    data = b"".join([values[i] for i in ids])
    return (data[1:] if data[:1] == b" " and ids and values[ids[0]][:1] == b" " else data).decode("utf-8", "replace")


@lru_cache(1)
def _encoder(model: bytes) -> Encoder:
    return Encoder(Vocabulary(model))


def read_model(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def _ids_array(done: list[bytes]) -> tuple[pa.Array, pa.Array]:
    """Ids and their numbers, from the encoder's int32 bytes."""
    ends = np.cumsum([0, *(len(x) // 4 for x in done)], dtype=np.int32)
    flat = pa.Array.from_buffers(pa.int32(), int(ends[-1]), [None, pa.py_buffer(b"".join(done))])
    return pa.ListArray.from_arrays(pa.array(ends), flat), pa.array(np.diff(ends).astype(np.int32))


def encode(docs: DataFrame, model: bytes, text_col: str = "text") -> DataFrame:
    """``docs`` with ``ids`` (array of int) and ``n_ids``. The model file is
    a parameter of a few hundred KB and travels with the function."""
    src = docs.drop("ids", "n_ids")
    schema = with_fields(src, ("ids", T.ArrayType(T.IntegerType(), False)), ("n_ids", T.IntegerType()))

    def run(batches):
        encoder = _encoder(model)
        for batch in batches:
            for part in slices(batch, text_col, SLICE_BYTES):
                ids, n = _ids_array([encoder.encode(t) for t in part.column(text_col).to_pylist()])
                yield pa.RecordBatch.from_arrays([*part.columns, ids, n], names=schema.names)

    return src.mapInArrow(run, schema)


def decode(rows: DataFrame, model: bytes, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """``rows`` with the text of their ids."""
    src = rows.drop(out)
    schema = with_fields(src, (out, T.StringType()))

    def run(batches):
        values = _encoder(model).v.values
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                texts = [decode_ids(x.values.to_pylist() if x.is_valid else [], values) for x in part.column(ids_col)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=schema.names)

    return src.mapInArrow(run, schema)


def round_trip(docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text", carried: Sequence[str] = ()) -> DataFrame:
    """Encode and decode in one pass: ``doc_id, ids, n_ids, decoded_crc32,
    round_trip`` (whether decoding the ids gives the text again), and the
    columns ``carried`` as they are."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), *carried)
    schema = T.StructType([src.schema["doc_id"], T.StructField("ids", T.ArrayType(T.IntegerType(), False)), T.StructField("n_ids", T.IntegerType()),
                           T.StructField("decoded_crc32", T.LongType()), T.StructField("round_trip", T.BooleanType()),
                           *src.schema.fields[2:]])

    def run(batches):
        encoder = _encoder(model)
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                texts = part.column("text").to_pylist()
                done = [encoder.encode(t) for t in texts]
                ids, n = _ids_array(done)
                back = [decode_ids(np.frombuffer(x, "<i4").tolist(), encoder.v.values) for x in done]
                sums = [zlib.crc32(t.encode()) for t in back]
                same = [a == (b or "") for a, b in zip(back, texts)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), ids, n, pa.array(sums, pa.int64()), pa.array(same), *part.columns[2:]], names=schema.names)

    return src.mapInArrow(run, schema)
