"""SentencePiece encoding and decoding as a weighted finite-state transducer.

Three machines are compiled from a model file: the normaliser N (dummy prefix,
space to U+2581), the piece transducer L (the lexicon of pieces, with byte
pieces for characters that no piece holds) and a bigram acceptor G over pieces.
Composing them with an input gives a lattice; its shortest path in the tropical
semiring (weights add along a path, the minimum wins) is the encoding.

For a model of merges, G carries the merge rule: the arc from piece p to piece q
weighs one if merging the characters of p+q by the model's scores gives p, q
again, and infinity otherwise. A sequence of pieces is the merge result of a text
exactly if each piece and each neighbouring pair merges to itself, so one path of
finite weight is left and it equals the merge algorithm's result. The search tries
long pieces first and remembers states that only infinite arcs leave; the first
complete path is the shortest. Arcs of G are compiled when first met and kept.
Words are short and many, so the new ones of a batch are solved together: since
each place of a lattice is reached at finite weight with one last piece only, the
forward pass over all of them is a few numpy steps per place.

No piece crosses a pair of characters that stands in no piece, so the lattice is
cut there and the parts are solved alone; a worker keeps the solved words in a
bounded cache. Inside the transducer a plain space stands for U+2581.

Null texts count as empty and have no pieces. Very long texts are solved part by
part; repeated rows are encoded one by one; other columns are never read.
Decoding inverts the path: pieces to text, byte pieces to UTF-8, U+2581 to
space, the dummy prefix dropped; ids that are no pieces (control ids) are
skipped. Models with a character map are refused.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from slotwise.llm import bytewords as bw
from slotwise.llm.graph import small_batches

SPACE = "▁"
CACHE_SIZE = 1 << 18
ARC_CACHE = 1 << 19
ARC_SLOTS = 1 << 21           # slots of the arc table of the batched search
WORD = 24                     # longest word for it
MANY = 256                    # new words from which they are solved together
OUT_ROWS = 200              # texts encoded at once
_NORMAL, _UNKNOWN, _CONTROL, _USER, _UNUSED, _BYTE = 1, 2, 3, 4, 5, 6
_WORKER: dict[str, "Transducer"] = {}


def _prefix(flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums for hashes of ranges of code points, and the factors that
    make them independent of the place."""
    power, inverse = bw.powers(len(flat) + 1)
    prefix = np.zeros(len(flat) + 1, np.uint64)
    np.cumsum(bw.mix(flat.astype(np.uint64) + np.uint64(1)) * power[:-1], out=prefix[1:])
    return prefix, inverse


def _ranges(flat: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    prefix, inverse = _prefix(flat)
    return (prefix[end] - prefix[start]) * inverse[start]


class Transducer:
    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as pb
        model = pb.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        spec = model.normalizer_spec
        kinds = {p.type for p in model.pieces}
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces or model.trainer_spec.model_type != 2:
            raise ValueError("only merge models with an identity normaliser are supported")
        if kinds & {_USER, _UNUSED} or _BYTE not in kinds:
            raise ValueError("models with user-defined or unused pieces, or without byte pieces, are not supported")
        self.prefix = " " if spec.add_dummy_prefix else ""
        self.text = [p.piece.replace(SPACE, " ") for p in model.pieces]
        self.kind = [p.type for p in model.pieces]
        normal = [i for i, k in enumerate(self.kind) if k == _NORMAL]
        self.id = {self.text[i]: i for i in normal}
        self.score = {self.text[i]: model.pieces[i].score for i in normal}
        self.byte = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == _BYTE}
        self.byte_of = {i: b for b, i in self.byte.items()}
        self.type = np.dtype(np.uint16 if len(self.kind) <= 1 << 16 else np.uint32)
        self.pairs = {p[i:i + 2] for p in self.id for i in range(len(p) - 1)}
        self.chars = {c for p in self.id for c in p}
        alone = "".join(map(re.escape, sorted(set("\n\t\r\x0b\x0c") - self.chars)))
        if any(p[i] != " " and p[i + 1] == " " for p in self.id for i in range(len(p) - 1)):
            words = r"(?s:.+)"          # pieces may cross words: the whole text is one part
        else:
            words = f" *[^ {alone}]+| +|[{alone}]+" if alone else " *[^ ]+| +"
        self.words = re.compile(words).findall
        # L: the pieces that merge to themselves; others are on no finite path
        self.lexicon = {p for p in self.id if self.merged(p) == [p]}
        self.longest = max(map(len, self.lexicon))
        # longest piece per first two characters
        self.reach: dict[str, int] = {}
        for p in self.lexicon:
            self.reach[p[:2]] = max(len(p), self.reach.get(p[:2], 0))
        # decoding of ids that stand for themselves: pieces and ASCII bytes
        self.plain = [chr(self.byte_of[i]) if self.byte_of.get(i, 128) < 128 else p if k == _NORMAL else ""
                      for i, (p, k) in enumerate(zip(self.text, self.kind))]
        self.high = np.zeros(len(self.kind), bool)
        self.high[[i for i, b in self.byte_of.items() if b >= 128]] = True
        self.arcs: dict[str, dict[str, bool]] = {}
        self.n_arcs = 0
        self.cache: dict[str, bytes] = {}
        lexicon = sorted(self.lexicon)
        flat, start, size = self._flat(lexicon)
        known = bw.mix(_ranges(flat, start, start + size))
        order = np.argsort(known)
        self.known, self.known_id = known[order], np.array([self.id[p] for p in lexicon])[order]
        self.length = np.array([len(p) for p in self.text])
        self.slot_key = np.full(ARC_SLOTS, -1, np.int64)
        self.slot_ok = np.zeros(ARC_SLOTS, bool)

    def merged(self, text: str) -> list[str]:
        """The merge rule on a short text: best score first, then leftmost."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = self.score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def arc(self, p: str, q: str) -> bool:
        """Compiles whether G's arc from p to q is finite."""
        if self.n_arcs >= ARC_CACHE:
            for row in self.arcs.values():
                row.clear()
            self.n_arcs = 0
        self.n_arcs += 1
        ok = self.arcs[p][q] = self.merged(p + q) == [p, q]
        return ok

    def shortest(self, part: str) -> list[str]:
        """Shortest path through the lattice of one part."""
        lexicon, arcs, reach, n = self.lexicon, self.arcs, self.reach, len(part)
        path: list[str] = []
        above: list[tuple[int, int]] = []       # per piece of the path: its place, and the end tried next there
        dead: set[tuple[int, str]] = set()
        i, row = 0, None
        j = min(n, reach.get(part[:2], 1))
        while True:
            while j > i:
                q = part[i:j]
                if q in lexicon:
                    if row is None:
                        ok = True
                    else:
                        ok = row.get(q)
                        if ok is None:
                            ok = self.arc(path[-1], q)
                    if ok and (j, q) not in dead:
                        break
                j -= 1
            if j > i:
                path.append(q)
                if j == n:
                    return path
                above.append((i, j))
                i, row = j, arcs.setdefault(q, {})
                j = min(n, i + reach.get(part[i:i + 2], 1))
            else:                               # only infinite arcs leave this state
                q = path.pop()
                dead.add((i, q))
                i, j = above.pop()
                row = arcs[path[-1]] if path else None
                j -= 1

    @staticmethod
    def _flat(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Code points of the words in a row, first places, lengths."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        return flat, np.cumsum(size) - size, size

    def finite(self, p: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Whether G's arcs from p to q are finite."""
        key = (p << 32) | q
        slot = (bw.mix(key.astype(np.uint64)) & np.uint64(ARC_SLOTS - 1)).astype(np.int64)
        new = np.flatnonzero(self.slot_key[slot] != key)
        if len(new):
            fresh, back = np.unique(key[new], return_inverse=True)
            ok = np.array([self.merged(self.text[k >> 32] + self.text[k & 0xFFFFFFFF]) == [self.text[k >> 32], self.text[k & 0xFFFFFFFF]]
                           for k in fresh.tolist()])
            out = self.slot_ok[slot]
            out[new] = ok[back]
            self.slot_key[slot[new]], self.slot_ok[slot[new]] = key[new], ok[back]
            return out
        return self.slot_ok[slot]

    def solve_words(self, words: list[str]) -> list[bytes]:
        """Shortest paths of many words of known characters, place by place."""
        flat, start, size = self._flat(words)
        prefix, inverse = _prefix(flat)
        word = np.repeat(np.arange(len(words)), size)
        place = np.arange(len(flat)) - start[word]
        arcs = []
        for n in range(1, min(self.longest, int(size.max())) + 1):      # arcs of L, by length
            at = np.flatnonzero(place + n <= size[word])
            i, k = bw.lookup(self.known, bw.mix((prefix[at + n] - prefix[at]) * inverse[at]))
            arcs.append((at[i], place[at[i]] + n, self.known_id[k]))
        begin, end, q = (np.concatenate(x) for x in zip(*arcs))
        order = np.argsort(end, kind="stable")
        begin, end, q = begin[order], end[order], q[order]
        last = np.full(len(flat), -1)                   # live piece that ends with the character at each place
        edge = np.searchsorted(end, np.arange(1, int(size.max()) + 2))
        for a, z in zip(edge[:-1], edge[1:]):
            b, qq = begin[a:z], q[a:z]
            first = place[b] == 0
            p = np.where(first, 0, last[b - 1])
            ok = first | (p >= 0)
            ok[ok & ~first] = self.finite(p[ok & ~first], qq[ok & ~first])
            last[b[ok] + self.length[qq[ok]] - 1] = qq[ok]
        at, who, steps = start + size, np.arange(len(words)), []
        while len(who):                                 # the way back
            piece = last[at - 1]
            steps.append((who, piece))
            at = at - self.length[piece]
            more = at > start[who]
            at, who = at[more], who[more]
        who, piece = (np.concatenate(x) for x in zip(*steps[::-1]))
        order = np.argsort(who, kind="stable")
        data = piece[order].astype(self.type).tobytes()
        ends = (np.cumsum(np.bincount(who, minlength=len(words))) * self.type.itemsize).tolist()
        return [data[a:z] for a, z in zip([0, *ends], ends)]

    def solve(self, word: str) -> bytes:
        out: list[int] = []
        if word in self.lexicon:
            out.append(self.id[word])
        else:
            lo = 0
            for i in range(1, len(word) + 1):
                if i == len(word) or word[i - 1:i + 1] not in self.pairs:
                    part = word[lo:i]
                    lo = i
                    if part in self.id or len(part) > 1:
                        out += map(self.id.__getitem__, self.shortest(part))
                    else:
                        out += [self.byte[b] for b in part.encode()]
        return np.array(out, self.type).tobytes()

    def encode_batch(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.cache) >= CACHE_SIZE:
            self.cache.clear()
        cut, todo = [], {}
        for text in texts:
            words = self.words(self.prefix + text.replace(SPACE, " ")) if text else []
            ids = list(map(self.cache.get, words))
            missing = [k for k, x in enumerate(ids) if x is None] if None in ids else []
            cut.append((words, ids, missing))
            todo.update(dict.fromkeys(words[k] for k in missing))
        if todo:
            plain = [w for w in todo if len(w) <= WORD and self.chars.issuperset(w)]
            found = dict(zip(plain, self.solve_words(plain))) if len(plain) >= MANY else {}
            for w in todo:
                if w not in found:
                    found[w] = self.solve(w)
            self.cache.update((w, x) for w, x in found.items() if len(w) <= 64)
            for words, ids, missing in cut:
                for k in missing:
                    ids[k] = found[words[k]]
        return [np.frombuffer(b"".join(ids), self.type) for _, ids, _ in cut]

    def encode(self, text: str) -> np.ndarray:
        return self.encode_batch([text])[0]

    def decode(self, ids) -> str:
        ids = np.asarray(ids, np.int64)
        ids = ids[(ids >= 0) & (ids < len(self.kind))]
        if self.high[ids].any():
            text = self.with_bytes(ids.tolist())
        else:
            text = "".join(map(self.plain.__getitem__, ids.tolist()))
        return text[1:] if self.prefix and text.startswith(" ") else text

    def with_bytes(self, ids: list[int]) -> str:
        out, pending = [], bytearray()
        for i in ids:
            b = self.byte_of.get(i)
            if b is not None:
                pending.append(b)
                continue
            if pending:
                out.append(pending.decode("utf-8", "replace"))
                pending.clear()
            if self.kind[i] == _NORMAL:
                out.append(self.text[i])
        if pending:
            out.append(pending.decode("utf-8", "replace"))
        return "".join(out)


def transducer(path: str) -> Transducer:
    if path not in _WORKER:
        _WORKER[path] = Transducer(path)
    return _WORKER[path]


def encode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text",
           decoded_col: str | None = None) -> DataFrame:
    """One row per input row: id, ``ids`` (the pieces of the text) and, if asked
    for, the text decoded from them, in the same pass."""
    src = small_batches(docs).select(docs[id_col].alias(id_col), docs[text_col].alias("_text"))
    names = [id_col, "ids", *([decoded_col] if decoded_col else [])]

    @bw.tidy
    def run(batches):
        t = transducer(model)
        for b in (b.slice(k, OUT_ROWS) for b in batches for k in range(0, b.num_rows, OUT_ROWS)):
            ids = t.encode_batch([x or "" for x in b.column(1).to_pylist()])
            ends = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int32)
            flat = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids).astype(np.int32)))
            text = [pa.array([t.decode(x) for x in ids], pa.string())] if decoded_col else []
            yield pa.RecordBatch.from_arrays([b.column(0), flat, *text], names=names)

    schema = f"`{id_col}` {src.schema[0].dataType.simpleString()}, ids array<int>"
    return src.mapInArrow(run, schema + (f", `{decoded_col}` string" if decoded_col else ""))


def decode(encoded: DataFrame, model: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """The input rows with their text in ``out_col``; null ids give null."""
    from pyspark.sql.functions import lit
    src = small_batches(encoded).withColumn(out_col, lit(None).cast("string"))
    at, out = src.columns.index(ids_col), src.columns.index(out_col)

    @bw.tidy
    def run(batches):
        t = transducer(model)
        for b in batches:
            text = [t.decode(x.values.to_numpy()) if x.is_valid else None for x in b.column(at)]
            cols = list(b.columns)
            cols[out] = pa.array(text, pa.string())
            yield pa.RecordBatch.from_arrays(cols, names=b.schema.names)

    return src.mapInArrow(run, src.schema)
