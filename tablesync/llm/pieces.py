"""SentencePiece ids of texts by N-best segmentation of the piece lattice, and back.

The pieces and their scores come from a public model file. A forward Viterbi pass over a lattice gives the best
score up to each place; these scores are the exact heuristic of an A* search backwards from the end, which
then meets the segmentations in order of their scores. Lattices are cut at places that no piece of the
vocabulary spans, so a text's N best segmentations are put together exactly from those of its chunks. Chunks, each with
the spaces before it, are cut further between characters that no piece joins, letters and punctuation above all; these
parts are searched once and kept.

Conventions are those of the model: one space is put before the text and stands as U+2581; a character
without a piece becomes its UTF-8 bytes. A U+2581 of the text itself becomes bytes as well, so decoding gives
back every text exactly. Of segmentations with one score, the one found first counts as better.

Defined results: a NULL or empty text has no ids, score 0 and one segmentation; repeated rows get equal results;
an empty table gives an empty result; a text is encoded whole whatever its length. Other columns are not read.
"""

from __future__ import annotations

import heapq
import re
import struct
import zlib
from array import array
from bisect import insort
from collections.abc import Iterator
from itertools import product
from operator import add, itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import named

SPACE = "▁"
#: Chunk that stands for a U+2581 of the text itself; no text has such a chunk, for a chunk holds U+2581 at its start only.
OWN_SPACE = "\0" + SPACE
N_BEST = 3
#: Bytes of parts kept by one Python worker, and of what else it keeps; later ones are searched each time.
KEPT = 96 << 20
KEPT_ELSE = 16 << 20
#: Bytes that something kept takes beside its characters and ids: two objects and a place in a dictionary.
ENTRY = 130
#: Characters at each place of a chunk whose pieces are looked up at once.
HEAD = 4
#: Documents of one output batch.
ROWS = 500


#: Before the ids of a part: score, and what the second segmentation is worse by.
_COSTS = struct.Struct("<dd")
_costs, _ids = itemgetter(slice(_COSTS.size)), itemgetter(slice(_COSTS.size, None))


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Kept(dict):
    """A dictionary that takes what fits into so many bytes."""

    def __init__(self, room: int):
        super().__init__()
        self.room = room

    def keep(self, key: str, value, size: int):
        if size <= self.room:
            self.room -= size
            self[key] = value
        return value


class Pieces:
    """The lattice of one model file."""

    def __init__(self, path: str, n: int = N_BEST):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.n = n
        self.pieces: dict[str, tuple[int, float]] = {}
        self.bytes = [0] * 256
        self.surface = [b""] * model.get_piece_size()
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[3:-1], 16)
                self.bytes[value], self.surface[i] = i, bytes([value])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.pieces[piece] = i, model.get_score(i)
                self.surface[i] = piece.replace(SPACE, " ").encode()
        #: Of each character that goes on: the node behind it, and the piece that ends there.
        self.trie: dict[str, tuple[dict, tuple[int, float] | None]] = {}
        for piece, found in self.pieces.items():
            node = self.trie
            for char in piece[:-1]:
                node = node.setdefault(char, ({}, None))[0]
            node[piece[-1]] = node[piece[-1]][0] if piece[-1] in node else {}, found
        self.longest = max(map(len, self.pieces))
        self.pairs = {p[k : k + 2] for p in self.pieces for k in range(len(p) - 1)}
        if any(pair[1] == SPACE != pair[0] for pair in self.pairs):
            raise ValueError("the vocabulary has pieces that go on behind a space")
        # Chunks keep the spaces of their text, as strings without U+2581 are small; ``_forward`` puts it there.
        self.pairs = {pair.replace(SPACE, " ") for pair in self.pairs}
        self.heads = Kept(KEPT_ELSE)
        #: Of a character without a piece: below any piece, as in the public library.
        self.unknown = -float(len(self.surface)) - 10
        # Of a part: score, what the second segmentation is worse by, ids, in one object.
        self.kept = Kept(KEPT)
        self.ways = Kept(KEPT_ELSE)
        alike = "".join(f"[{re.escape(''.join(group))}]+|" for group in self._groups())
        self._find = re.compile(f" *(?:{alike}[^ ])| +", re.DOTALL).findall
        self.kept[OWN_SPACE] = _COSTS.pack(self.unknown, np.inf) + array("I", [self.bytes[b] for b in SPACE.encode()]).tobytes()

    def _groups(self) -> list[list[str]]:
        """Characters that pieces join, directly or through others; the largest group first."""
        group: dict[str, list[str]] = {}
        for pair in sorted(self.pairs):
            if pair[0] != " ":
                one, other = (group.setdefault(char, [char]) for char in pair)
                if one is not other:
                    one += other
                    for char in other:
                        group[char] = one
        return sorted({id(x): x for x in group.values()}.values(), key=len, reverse=True)

    def _head(self, head: str) -> tuple[list[tuple[int, tuple]], dict | None]:
        """(length, piece) of the pieces at the start of a few characters, and the node behind them if any go on."""
        ends, node = [], self.trie
        for k, char in enumerate(head, 1):
            node, found = node.get(char) or ({}, None)
            if found is not None:
                ends.append((k, found))
            elif k == 1:  # the character has no piece
                ends.append((1, (tuple([self.bytes[b] for b in char.encode()]), self.unknown)))
        out = ends, node if len(head) == HEAD else None
        return self.heads.keep(head, out, (2 + len(ends)) * ENTRY)

    def _forward(self, chunk: str) -> tuple[list[float], list, list[list]]:
        """Of each place of a chunk: the least cost up to it, the edge of that cost, and all edges into it."""
        chunk = chunk.replace(" ", SPACE)
        size, longest, heads = len(chunk), self.longest, self.heads
        best = [0.0] + [np.inf] * size  # costs: scores with the sign turned
        lead: list = [None] * (size + 1)  # cheapest edge into each place, of equal ones the longest
        edges: list[list] = [[] for _ in range(size + 1)]
        for i in range(size):
            here, head = best[i], chunk[i : i + HEAD]
            ends, node = heads.get(head) or self._head(head)
            for k, found in ends:
                j, cost = i + k, here - found[1]
                edge = cost, i, found
                edges[j].append(edge)
                if cost < best[j]:
                    best[j], lead[j] = cost, edge
            if node:
                j = i + HEAD
                for char in chunk[j : i + longest]:
                    step = node.get(char)
                    if step is None:
                        break
                    node, found = step
                    j += 1
                    if found is not None:
                        cost = here - found[1]
                        edge = cost, i, found
                        edges[j].append(edge)
                        if cost < best[j]:
                            best[j], lead[j] = cost, edge
        return best, lead, edges

    def search(self, chunk: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
        """The n best segmentations of a chunk as (score, ids), best first.

        As the heuristic is exact, every entry of the open list is the cost of a whole segmentation, and the
        cheapest way into a place goes on at that cost. So an entry is followed to the start at once, and no more
        entries are kept than segmentations are wanted: the work is n ways through the lattice, ties or not.
        """
        size = len(chunk)
        best, lead, edges = self._forward(chunk)
        count, room, out = 0, n, []
        opened: list = [(best[size], 0, size, 0.0, None, None)]
        while opened:
            _, _, at, done, path, edge = opened.pop(0)
            room -= 1
            while at:
                if edge is None:
                    edge = lead[at]
                    if room:
                        for other in edges[at]:
                            if other is not edge and (len(opened) < room or other[0] + done < opened[-1][0]):
                                count += 1
                                insort(opened, (other[0] + done, count, at, done, path, other))
                                del opened[room:]
                _, at, piece = edge
                edge = None
                done -= piece[1]
                path = piece[0], path
            ids: list[int] = []
            while path is not None:
                piece, path = path
                if piece.__class__ is tuple:
                    ids += piece
                else:
                    ids.append(piece)
            out.append((-done, tuple(ids)))
        return out

    def _cut(self, chunk: str) -> list[str]:
        """Parts of a chunk between which no piece of the vocabulary goes on."""
        pairs = self.pairs
        ends = [i for i, pair in enumerate(map(add, chunk, chunk[1:]), 1) if pair not in pairs]
        if not ends:
            return [chunk]
        return [chunk[i:j] for i, j in zip([0, *ends], [*ends, len(chunk)])]

    def _ways(self, chunk: str) -> list[tuple[float, tuple[int, ...]]]:
        """The n best segmentations of a chunk from those of its parts."""
        joined = self.ways.get(chunk)
        if joined is not None:
            return joined
        joined = [(0.0, ())]
        for part in self._cut(chunk):
            both = enumerate(product(joined, self.search(part, self.n)))
            best = heapq.nsmallest(self.n, ((-(a + b), k, x + y) for k, ((a, x), (b, y)) in both))
            joined = [(-s, ids) for s, _, ids in best]
        return self.ways.keep(chunk, joined, ENTRY + len(chunk) + sum(2 * ENTRY + 8 * len(ids) for _, ids in joined))

    def _part(self, part: str) -> bytes:
        """What is kept of a part."""
        best, lead, edges = self._forward(part)
        at, done, second, ids = len(part), 0.0, np.inf, []
        # The search backwards up to where the cost of the second segmentation is known.
        while at:
            edge = lead[at]
            if self.n > 1:
                for other in edges[at]:
                    if other[0] + done < second and other is not edge:
                        second = other[0] + done
            _, at, piece = edge
            done -= piece[1]
            if piece[0].__class__ is tuple:
                ids += piece[0][::-1]
            else:
                ids.append(piece[0])
        found = _COSTS.pack(-done, second - best[-1]) + array("I", ids[::-1]).tobytes()
        return self.kept.keep(part, found, ENTRY + len(part) + len(found))

    def _parts(self, text: str) -> list[str]:
        """The parts of a text; a U+2581 of the text itself is ``OWN_SPACE``."""
        out = []
        for k, body in enumerate(text.split(SPACE)):
            if k:
                out.append(OWN_SPACE)
            out += self._find(body if k else " " + body)
        return out

    def _entries(self, parts: list[str]) -> list[bytes]:
        get, own = self.kept.get, self._part
        return [get(p) or own(p) for p in parts]

    def encode(self, text: str | None) -> tuple[bytes, list[float]]:
        """Ids of the best segmentation as little-endian bytes, and the scores of the n best."""
        if not text:
            return b"", [0.0]
        parts = self._parts(text)
        entries = self._entries(parts)
        return b"".join(map(_ids, entries)), [s for s, _ in self._doc_best(parts, entries)]

    def segmentations(self, text: str | None) -> list[tuple[float, list[int]]]:
        """The n best segmentations of a text as (score, ids)."""
        return [(score, np.frombuffer(ids, dtype="<u4").tolist()) for score, ids in self.n_best(text)]

    def n_best(self, text: str | None) -> list[tuple[float, bytes]]:
        """The n best segmentations of a text as (score, ids as little-endian bytes)."""
        if not text:
            return [(0.0, b"")]
        parts = self._parts(text)
        entries, out = self._entries(parts), []
        best = list(map(_ids, entries))
        for score, choice in self._doc_best(parts, entries):
            own = best.copy()
            for (start, end), way in choice.items():
                ids = array("I", self._ways("".join(parts[start:end]))[way][1]).tobytes()
                own[start:end] = [ids, *[b""] * (end - start - 1)]
            out.append((score, b"".join(own)))
        return out

    def _chunk_at(self, parts: list[str], k: int) -> tuple[int, int]:
        """The chunk that a part belongs to, as the range of its parts."""
        starts = lambda i: parts[i][0] == " " or OWN_SPACE in parts[i - 1 : i + 1]
        start, end = k, k + 1
        while start and not starts(start):
            start -= 1
        while end < len(parts) and not starts(end):
            end += 1
        return start, end

    def _doc_best(self, parts: list[str], entries: list[bytes]) -> list[tuple[float, dict[tuple[int, int], int]]]:
        """(score, other segmentation by chunk) of the n best. Only the n - 1 chunks whose second segmentation
        costs least can differ from their best."""
        costs = np.frombuffer(b"".join(map(_costs, entries)), dtype="<f8").reshape(-1, 2)
        best = costs[:, 0].tolist()
        total, worse, few = sum(best), costs[:, 1].copy(), []
        for _ in range(self.n - 1):
            least = int(worse.argmin())
            if worse[least] == np.inf:
                break
            few.append(self._chunk_at(parts, least))
            worse[slice(*few[-1])] = np.inf
        ways = [[(sum(best[a:b]) - s, ((a, b), i)) for i, (s, _) in enumerate(self._ways("".join(parts[a:b])))] for a, b in few]
        choices = ((sum(c for c, _ in way), [x for _, x in way]) for way in product(*ways))
        return [(total - cost, {k: i for k, i in way if i}) for cost, way in heapq.nsmallest(self.n, choices)]

    def decode(self, ids: bytes) -> str:
        """The text of ids as little-endian bytes."""
        surface = self.surface
        return b"".join([surface[i] for i in np.frombuffer(ids, dtype="<u4").tolist()]).decode()[1:]


_loaded: dict[tuple[str, int], Pieces] = {}


def pieces(path: str, n: int = N_BEST) -> Pieces:
    """The worker's lattice for a model file, made once."""
    if (path, n) not in _loaded:
        _loaded[path, n] = Pieces(path, n)
    return _loaded[path, n]


def _lists(rows: list[bytes]) -> pa.ListArray:
    ends = np.cumsum([0] + [len(x) // 4 for x in rows], dtype=np.int64).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(rows), dtype="<i4")))


def encode(docs: DataFrame, text: str = "text", model: str | None = None, n: int = N_BEST, digest: bool = False) -> DataFrame:
    """doc_id, ids, n_tokens, scores of the n best segmentations, and whether decoding gives the text back.

    With ``digest`` the column ``ids_crc32`` stands for ids: their CRC-32, 32 bits each, little-endian; and behind the
    others stands ``segmentations``, the ids of all the n best, the best first.
    """
    model = model or default_model()
    column = "ids_crc32" if digest else "ids"

    def rows(lattice: Pieces, batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, scores, same, ways = [], [], [], []
        for body in batch.column(1).to_pylist():
            if digest:
                found = lattice.n_best(body)
                own, best = found[0][1], [score for score, _ in found]
                ways.append([x for _, x in found])
            else:
                own, best = lattice.encode(body)
            ids.append(own)
            scores.append(best)
            same.append(lattice.decode(own) == (body or ""))
        sizes = np.array([len(x) // 4 for x in ids], dtype=np.int64)
        shown = pa.array([zlib.crc32(x) for x in ids], pa.int64()) if digest else _lists(ids)
        columns = [batch.column(0), shown, pa.array(sizes), pa.array(scores, pa.list_(pa.float64())), pa.array(same, pa.bool_())]
        names = ["doc_id", column, "n_tokens", "scores", "decoded"]
        if digest:
            ends = np.cumsum([0] + [len(x) for x in ways], dtype=np.int64).astype(np.int32)
            columns.append(pa.ListArray.from_arrays(pa.array(ends), _lists([x for own in ways for x in own])))
            names.append("segmentations")
        return pa.RecordBatch.from_arrays(columns, names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = pieces(model, n)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                yield rows(lattice, batch.slice(at, ROWS))

    pairs = docs.select(named(docs, "doc_id").alias("doc_id"), named(docs, text).alias("text"))
    kind = pairs.schema["doc_id"].dataType.simpleString()
    shown, more = ("ids_crc32 long", ", segmentations array<array<int>>") if digest else ("ids array<int>", "")
    return pairs.mapInArrow(run, f"doc_id {kind}, {shown}, n_tokens long, scores array<double>, decoded boolean{more}")
