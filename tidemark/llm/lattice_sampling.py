"""SentencePiece encoding by sampling without replacement, and decoding.

A text spans a lattice of all ways to write it in pieces of the model. A segmentation has the probability of its
pieces' weights, normalised over the lattice; the weight of a piece falls with its rank as in Zipf's law, since the
models hold merge ranks and no probabilities. Gumbel top-k: the k segmentations with the largest perturbed
log-probabilities are k draws without replacement. A best-first (A*) search over prefixes finds them; the bound of a
prefix is the largest perturbed value below it, drawn top-down, so the first k leaves are the right ones.
"""

from __future__ import annotations

import heapq
import math
import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.llm.common import documents

MARK = "▁"  # stands for a space inside pieces
END = 0x110000  # follows the characters of a part
BYTE_WEIGHT = -30.0  # log weight of a character written in bytes
CACHE_NODES = 3_000_000  # nodes a worker remembers


GOLDEN, BITS = 0x9E3779B97F4A7C15, (1 << 64) - 1
# The multipliers of the 64-bit finaliser of SplitMix.
FIRST, SECOND = 0xBF58476D1CE4E5B9, 0x94D049BB133111EB


def mixed(x: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit counters as random bits."""
    x = x ^ x >> np.uint64(30)
    x *= np.uint64(FIRST)
    x ^= x >> np.uint64(27)
    x *= np.uint64(SECOND)
    x ^= x >> np.uint64(31)
    return x


def units(keys: np.ndarray, n: int | np.ndarray) -> np.ndarray:
    """The n-th random number between 0 and 1, both excluded, of the stream of each key."""
    return ((mixed(keys + np.uint64(GOLDEN) * np.asarray(n, np.uint64)) >> np.uint64(11)).astype(float) + 0.5) * 2.0 ** -53


def stream(seed: int, draw: int, use: int) -> np.uint64:
    """Key of the random numbers for one use in one draw of a text."""
    return mixed(np.array([(seed + (8 * draw + use + 1) * GOLDEN) & BITS], np.uint64))[0]


ROOT, CHOICE, OTHERS, PLACES, WALK = range(5)  # uses of random numbers


def marked(texts: pa.Array) -> pa.Array:
    """Texts with a blank before them, empty ones without, and with the word mark as a blank."""
    plain = pc.replace_substring(texts.cast(pa.large_string()), MARK, " ")
    blank, none = (pa.scalar(x, pa.large_string()) for x in (" ", ""))
    return pc.if_else(pc.equal(pc.binary_length(plain), 0), plain, pc.binary_join_element_wise(blank, plain, none))


def held(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Where the values of a large text or binary column begin and end in its bytes, and those."""
    offset = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offset[0]:offset[-1]]
    return offset - offset[0], data


def slots(keys: np.ndarray, size: int) -> np.ndarray:
    """Where the search for each key begins in a table of ``size``, a power of two."""
    return (keys.view(np.uint64) * np.uint64(GOLDEN) >> np.uint64(65 - size.bit_length())).view(np.int64)


def hash_table(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys and values in a table four times as wide or more; a key lies in its slot or after the full ones that follow."""
    size = 4 << len(keys).bit_length()
    held, out = np.full(size, -1, np.int64), np.zeros(size, np.int64)
    at, left = slots(keys, size), np.arange(len(keys))
    while len(left):
        free = left[held[at[left]] < 0]
        held[at[free]] = keys[free]  # of several keys for one slot the last one stays
        out[at[free]] = values[free]
        left = left[held[at[left]] != keys[left]]
        at[left] = (at[left] + 1) % size
    return held, out


class Pieces:
    """The pieces of one model file."""

    def __init__(self, model_file: str, sharpness: float, offset: float) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.text = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        special = [model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in range(len(self.text))]
        self.bytes = {int(p[3:5], 16): i for i, p in enumerate(self.text) if model.is_byte(i)}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        usual = [i for i, s in enumerate(special) if not s and i not in self.byte_of]
        usual.sort(key=lambda i: -model.get_score(i))
        # A tree of the pieces: from each prefix by one character to the next, the empty one is 0.
        prefixes = {"": 0}
        for i in usual:
            for k in range(1, len(self.text[i]) + 1):
                prefixes.setdefault(self.text[i][:k], len(prefixes))
        steps = sorted((prefixes[x[:-1]] << 21 | ord(x[-1]), n) for x, n in prefixes.items() if x)
        self.steps, self.leads = hash_table(*(np.array(x, np.int64) for x in zip(*steps, strict=True)))
        self.roots = np.zeros(END + 1, np.int32)
        for x, n in prefixes.items():
            if len(x) == 1:
                self.roots[ord(x)] = n
        self.ends = np.full(len(prefixes), -1, np.int64)
        self.weights = np.zeros(len(prefixes))
        for k, i in enumerate(usual):
            self.ends[prefixes[self.text[i]]] = i
            self.weights[prefixes[self.text[i]]] = -sharpness * math.log(offset + k)
        self.plain = [chr(self.byte_of[i]) if self.byte_of.get(i, 128) < 128 else t for i, t in enumerate(self.text)]
        self.high = {i for i, b in self.byte_of.items() if b >= 128}
        self.lines = not any("\n" in self.text[i] for i in usual)  # then a line break is a part of its own
        self.cut = re.compile(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n" if self.lines else f"{MARK}*[^{MARK}]+|{MARK}+")
        spelled = [bytes([self.byte_of[i]]) if i in self.byte_of else t.replace(MARK, " ").encode() for i, t in enumerate(self.text)]
        self.spelled = pa.array(spelled, pa.large_binary())

    def split(self, text: str) -> list[str]:
        """Parts of the text that no piece crosses."""
        return self.cut.findall(MARK + text.replace(" ", MARK)) if text else []

    def split_all(self, texts: pa.Array) -> tuple[np.ndarray, list[str], np.ndarray]:
        """The same for texts as ``marked`` gives them: the place of each part among the distinct ones, those, and at
        which parts the texts begin and end. A part becomes a Python object but once per batch."""
        offset, data = held(texts)
        first = np.zeros(len(data) + 1, bool)
        blank = data == 32
        first[1:-1] = blank[1:] & ~blank[:-1]
        if self.lines:
            line = data == 10
            first[:-1] |= line
            first[1:] |= line
        first[offset] = True
        bounds = np.flatnonzero(first)
        ends = np.searchsorted(bounds, offset)
        parts = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds), pa.py_buffer(data)]
        ).dictionary_encode()
        # One long text, cut by Python at a byte that UTF-8 has not got, is made faster than one object per value.
        whole = pa.ListArray.from_arrays([0, len(parts.dictionary)], parts.dictionary.cast(pa.binary()))
        text = pc.binary_join(whole, pa.scalar(b"\xff", pa.binary()))[0].as_py().decode("utf-8", "surrogateescape")
        return parts.indices.to_numpy(), text.replace(" ", MARK).split("\udcff") if len(parts) else [], ends

    def given_back(self, ids: list[np.ndarray], texts: pa.Array, of: list[int]) -> list[bool]:
        """Whether ids, the k-th of them for the text ``of[k]`` as ``marked`` gives it, decode to their text."""
        offset, data = held(texts)
        flat = np.concatenate([np.zeros(0, np.int64), *ids])
        stops, spelled = held(self.spelled.take(pa.array(flat)))
        stops = stops[np.cumsum([0, *map(len, ids)])].tolist()
        out = []
        for k, (a, b) in enumerate(zip(stops, stops[1:])):
            wanted = data[offset[of[k]]:offset[of[k] + 1]].tobytes()
            out.append(spelled[a:b].tobytes() == wanted or self.decode(ids[k].tolist()) == wanted[1:].decode())
        return out

    def edges(self, code: np.ndarray) -> tuple[np.ndarray, ...]:
        """start, end, piece, weight of all pieces inside the characters; parts are closed by the code END."""
        alone = code != END  # characters without a piece of their own are written in bytes
        start = np.flatnonzero(alone)
        end, state, found = start, np.zeros(len(start), np.int64), []
        while len(start):
            if not found:  # from the root: by the character alone
                state = self.roots[code[end]].astype(np.int64)
                hit = state > 0
                start, end, state = start[hit], end[hit] + 1, state[hit]
                whole = self.ends[state] >= 0
                found.append((start[whole], end[whole], self.ends[state[whole]], self.weights[state[whole]]))
                alone[start[whole]] = False
                continue
            step = state << 21 | code[end]
            place, open_ = slots(step, len(self.steps)), np.arange(len(step))
            while len(open_):
                held = self.steps[place[open_]]
                open_ = open_[(held >= 0) & (held != step[open_])]
                place[open_] = (place[open_] + 1) % len(self.steps)
            hit = self.steps[place] == step
            start, end, state = start[hit], end[hit] + 1, self.leads[place[hit]]
            whole = self.ends[state] >= 0
            found.append((start[whole], end[whole], self.ends[state[whole]], self.weights[state[whole]]))
        odd = np.flatnonzero(alone)
        found.insert(0, (odd, odd + 1, -1 - code[odd], np.full(len(odd), BYTE_WEIGHT)))
        # The edges of a character lie side by side, shorter ones first, as the rounds found them.
        n_edges = np.zeros(len(code), np.int64)
        for first, *_ in found:
            n_edges[first] += 1
        free = np.cumsum(n_edges) - n_edges
        columns = [np.empty(int(n_edges.sum()), x.dtype) for x in found[0]]
        for some in found:
            at = free[some[0]]
            free[some[0]] += 1
            for column, x in zip(columns, some, strict=True):
                column[at] = x
        return tuple(columns)

    def decode(self, ids: list[int]) -> str:
        if self.high.isdisjoint(ids):
            text = "".join(map(self.plain.__getitem__, ids)).replace(MARK, " ")
        else:
            parts = [bytes([self.byte_of[i]]) if i in self.byte_of else self.text[i].encode() for i in ids]
            text = b"".join(parts).decode("utf-8", "replace").replace(MARK, " ")
        return text[1:] if text.startswith(" ") else text


def put(held: np.ndarray, used: int, new: np.ndarray) -> np.ndarray:
    """The array with ``new`` after its first ``used`` values, in twice the space where it is full."""
    if used + len(new) > len(held):
        wider = np.empty(max(2 * len(held), used + len(new)), held.dtype)
        wider[:used] = held[:used]
        held = wider
    held[used:used + len(new)] = new
    return held


class Lattice:
    """Nodes and edges of the parts met so far; a part of n characters has n + 1 nodes in a row, the last without edges."""

    def __init__(self, pieces: Pieces) -> None:
        self.pieces = pieces
        self.clear()

    def clear(self) -> None:
        self.first: dict[str, int] = {}
        self.nodes = self.edges = 0
        self.begin = np.zeros(1, np.int64)  # first edge of each node, and the end of all
        # Of each edge: share of its node's edges up to it, log-probability, log-probability of all others of its node.
        self.upto, self.logp, self.others = np.empty(0), np.empty(0), np.empty(0)
        self.target, self.piece = np.empty(0, np.int32), np.empty(0, np.int32)

    def add(self, parts: list[str]) -> np.ndarray:
        """Takes in new parts; the first node of each."""
        if not parts:
            return np.zeros(0, np.int64)
        ends = "\n".join(parts) + "\n"  # any character holds the place of END
        code = np.frombuffer(ends.encode("utf-32-le"), np.uint32).astype(np.int64)
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        close = np.cumsum(sizes + 1) - 1
        code[close] = END
        start, end, piece, weight = self.pieces.edges(code)
        n = len(code)
        begin = np.append(0, np.cumsum(np.bincount(start, minlength=n)))
        # Log mass of all ways from a node to the end of its part, for nodes at growing distance from that end.
        after = np.zeros(n)
        left = np.repeat(close, np.diff(close, prepend=-1)) - np.arange(n)
        far = left[start]
        most = int(far.max())
        order = np.argsort(far.astype(np.uint16) if most < 1 << 16 else far, kind="stable")
        bounds = np.cumsum(np.bincount(far, minlength=most + 1))
        for k in range(len(bounds) - 1):
            some = order[bounds[k]:bounds[k + 1]]
            value = weight[some] + after[end[some]]
            heads = np.flatnonzero(np.diff(start[some], prepend=-1))
            top = np.maximum.reduceat(value, heads)
            widths = np.diff(heads, append=len(some))
            after[start[some[heads]]] = top + np.log(np.add.reduceat(np.exp(value - np.repeat(top, widths)), heads))
        logp = weight + after[end] - after[start]
        logp[np.diff(begin)[start] == 1] = 0.0
        share = np.exp(logp)
        total = np.cumsum(share)
        upto = total - (total - share)[begin[start]]
        last = begin[1:][np.diff(begin) > 0] - 1
        upto[last] = 1.0
        self.begin = put(self.begin, self.nodes, begin + self.edges)
        with np.errstate(divide="ignore"):
            others = np.log(-np.expm1(logp))
        self.upto, self.logp = put(self.upto, self.edges, upto), put(self.logp, self.edges, logp)
        self.others = put(self.others, self.edges, others)
        self.target, self.piece = put(self.target, self.edges, end + self.nodes), put(self.piece, self.edges, piece)
        nodes = self.nodes + close - sizes
        self.first.update(zip(parts, nodes.tolist(), strict=True))
        self.nodes += n
        self.edges += len(logp)
        return nodes

    def walk(self, nodes: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One way from every node to the end of its part, by the stream of its key: the edges of all nodes one after the
        other, in reading order, and how many each has."""
        length, found = np.zeros(len(nodes), np.int64), []
        active, at = np.arange(len(nodes)), nodes
        while True:
            edge = self.begin[at]
            open_ = edge < self.begin[at + 1]
            if not open_.all():
                active, edge, keys = active[open_], edge[open_], keys[open_]
            if not len(active):
                break
            drawn = units(keys, len(found))
            late = np.flatnonzero(drawn >= self.upto[edge])
            while len(late):
                edge[late] += 1
                late = late[drawn[late] >= self.upto[edge[late]]]
            found.append((active, edge))
            length[active] += 1
            at = self.target[edge]
        first = np.cumsum(length) - length
        edges = np.empty(int(length.sum()), np.int64)
        for step, (active, edge) in enumerate(found):
            edges[first[active] + step] = edge
        return edges, length

    def edges_of(self, node: int) -> range:
        return range(int(self.begin[node]), int(self.begin[node + 1]))


class Leaf:
    """A segmentation: its edges, how many each part has, the log-probability before each, and its perturbed value."""

    def __init__(self, edges: np.ndarray, lengths: np.ndarray, logp: np.ndarray, value: float) -> None:
        self.edges, self.lengths, self.value = edges, lengths, value
        self.before = np.concatenate([[0.0], np.cumsum(logp)])


def gumbel_below(drawn: np.ndarray, most: float) -> np.ndarray:
    """Gumbel draws, conditioned on being at most ``most``; larger draws stay larger."""
    return -np.logaddexp(-most, -drawn)


class Search:
    """Best-first search for the k segmentations of a text with the largest perturbed values, one walk at a time."""

    def __init__(self, lattice: Lattice, starts: np.ndarray, k: int, seed: int) -> None:
        self.lattice, self.starts, self.k, self.seed = lattice, starts, k, seed
        self.leaves: list[Leaf] = []
        self.tie = 0
        # Each entry bounds the segmentations that share ``place`` edges with ``leaf`` and there take none of ``taken``.
        root = -math.log(-math.log(self.unit(0, ROOT)))
        self.frontier: list[tuple[float, int, Leaf | None, int, tuple[int, ...]]] = [(-root, 0, None, 0, ())]

    def unit(self, draw: int, use: int) -> float:
        return float(units(np.array([stream(self.seed, draw, use)]), 0)[0])

    def open(self) -> bool:
        return bool(self.frontier) and len(self.leaves) < self.k

    @property
    def threshold(self) -> float:
        """The perturbed value that comes after the leaves."""
        return -self.frontier[0][0] if self.frontier else -math.inf

    def ask(self) -> tuple[np.ndarray, np.ndarray]:
        """Takes the best entry; the nodes to walk on from, with the keys of their random numbers."""
        value, _, leaf, place, taken = heapq.heappop(self.frontier)
        self.value, self.leaf, self.place, self.taken = -value, leaf, place, taken
        lattice, starts, draw = self.lattice, self.starts, len(self.leaves)
        key = stream(self.seed, draw, WALK)
        if leaf is None:
            self.part, nodes = 0, starts
        else:
            # One more edge at this place, among those not taken, then any way on to the end of the text.
            ends = np.cumsum(leaf.lengths)
            part = self.part = int(np.searchsorted(ends, place, side="right"))
            self.within = place - int(ends[part] - leaf.lengths[part])  # edges of the part before the place
            at = int(lattice.target[leaf.edges[place - 1]]) if self.within else int(starts[part])
            self.choice = [e for e in lattice.edges_of(at) if e not in taken]
            share = np.exp(lattice.logp[self.choice])
            drawn = self.unit(draw, CHOICE) * share.sum()
            self.edge = self.choice[min(len(self.choice) - 1, int(np.searchsorted(np.cumsum(share), drawn, side="right")))]
            nodes = np.concatenate([[lattice.target[self.edge]], starts[part + 1:]])
        return nodes, mixed(key + np.uint64(GOLDEN) * np.arange(self.part, self.part + len(nodes), dtype=np.uint64))

    def take(self, edges: np.ndarray, length: np.ndarray) -> None:
        """The ways that were walked: the next leaf, and what it leaves open."""
        lattice, value, leaf, place, draw = self.lattice, self.value, self.leaf, self.place, len(self.leaves)
        changed, rest = 0, []
        if leaf is not None:
            edges = np.concatenate([leaf.edges[:place], [self.edge], edges])
            length = np.concatenate([leaf.lengths[:self.part], length[:1] + self.within + 1, length[1:]])
            changed = place + 1
        new = Leaf(edges, length, lattice.logp[edges], value)
        self.leaves.append(new)
        if leaf is not None:
            others = [e for e in self.choice if e != self.edge]
            if others:
                mass = float(new.before[place]) + float(np.log(np.exp(lattice.logp[others]).sum()))
                drawn = mass - math.log(-math.log(self.unit(draw, OTHERS)))
                rest.append((float(gumbel_below(drawn, value)), place, (*self.taken, self.edge)))
        free = lattice.others[edges[changed:]]
        places = np.flatnonzero(free > -np.inf)
        if len(places):
            location = new.before[changed:-1][places] + free[places]
            drawn = location - np.log(-np.log(units(stream(self.seed, draw, PLACES), places + changed)))
            # No more than the segmentations still wanted, and the next one, can come from here.
            wanted = self.k - len(self.leaves) + 1
            if wanted == 1:
                keep = np.array([drawn.argmax()])
            else:
                keep = np.argpartition(-drawn, wanted - 1)[:wanted] if wanted < len(drawn) else np.arange(len(drawn))
            for bound, at in zip(gumbel_below(drawn[keep], value).tolist(), (places[keep] + changed).tolist(), strict=True):
                rest.append((bound, at, (int(edges[at]),)))
        for bound, where, without in rest:
            self.tie += 1
            heapq.heappush(self.frontier, (-bound, self.tie, new, where, without))


def top_k(lattice: Lattice, starts: list[np.ndarray], k: int, seeds: list[int]) -> list[Search]:
    """Finished searches of all texts: in each round the walks of all texts are one."""
    searches = [Search(lattice, s, k, seed) for s, seed in zip(starts, seeds, strict=True)]
    while some := [s for s in searches if s.open()]:
        nodes, keys = zip(*[s.ask() for s in some], strict=True)
        edges, length = lattice.walk(np.concatenate(nodes), np.concatenate(keys))
        part = np.cumsum([0, *map(len, nodes)])
        edge = np.append(0, np.cumsum(length))[part].tolist()
        for j, s in enumerate(some):
            s.take(edges[edge[j]:edge[j + 1]], length[part[j]:part[j + 1]])
    return searches


def log_inclusion(logp: float, threshold: float) -> float:
    """Log of the probability that a segmentation's perturbed value passes the threshold."""
    gap = logp - threshold
    if gap == math.inf:
        return 0.0
    return gap if gap < -30 else math.log(-math.expm1(-math.exp(min(gap, 700.0))))


class Sampler:
    def __init__(self, model_file: str, sharpness: float, offset: float) -> None:
        self.pieces = Pieces(model_file, sharpness, offset)
        self.lattice = Lattice(self.pieces)

    def prepare(self, texts: list[str]) -> list[list[str]]:
        cut = [self.pieces.split(t) for t in texts]
        lattice = self.lattice
        if lattice.nodes > CACHE_NODES:
            lattice.clear()
        lattice.add(list(set(chain.from_iterable(cut)).difference(lattice.first)))
        return cut

    def starts(self, texts: pa.Array) -> list[np.ndarray]:
        """The nodes at which the parts of each text, as ``marked`` gives it, begin."""
        place, distinct, ends = self.pieces.split_all(texts)
        lattice = self.lattice
        if lattice.nodes > CACHE_NODES:
            lattice.clear()
        found = list(map(lattice.first.get, distinct))
        new = [k for k, node in enumerate(found) if node is None]
        flat = np.array(found, np.float64)  # nodes are whole numbers far below 2^53, and None becomes nan
        flat[new] = lattice.add([distinct[k] for k in new])
        flat = flat.astype(np.int64)[place]
        return [flat[a:b] for a, b in zip(ends.tolist(), ends[1:].tolist())]

    def ids(self, several: list[np.ndarray]) -> list[np.ndarray]:
        """Ids of each of the ways, with the bytes of characters that have no piece."""
        found = self.lattice.piece[np.concatenate([np.zeros(0, np.int64), *several])]
        ends = np.cumsum([0, *map(len, several)])
        odd = np.flatnonzero(found < 0)
        if len(odd):
            as_bytes = [[self.pieces.bytes[b] for b in chr(-int(c) - 1).encode()] for c in found[odd]]
            sizes = np.ones(len(found), np.int64)
            sizes[odd] = [len(b) for b in as_bytes]
            out = np.repeat(found, sizes)
            first = np.cumsum(sizes) - sizes
            for k, b in zip(odd, as_bytes, strict=True):
                out[first[k]:first[k] + len(b)] = b
            found, ends = out, np.append(0, np.cumsum(sizes))[ends]
        return [found[a:b] for a, b in zip(ends.tolist(), ends[1:].tolist())]

    def sample_all(self, texts: list[list[str]], k: int, seeds: list[int]) -> list[list[tuple[np.ndarray, float, float, float]]]:
        """For each text, cut into parts, up to k segmentations as (ids, log-probability, perturbed value, log inclusion
        probability)."""
        flat = np.fromiter(map(self.lattice.first.__getitem__, chain.from_iterable(texts)), np.int64)
        ends = np.cumsum([0, *map(len, texts)]).tolist()
        return self.sample_from([flat[a:b] for a, b in zip(ends, ends[1:])], k, seeds)

    def sample_from(self, starts: list[np.ndarray], k: int, seeds: list[int]) -> list[list[tuple[np.ndarray, float, float, float]]]:
        """The same for texts given by the nodes at which their parts begin."""
        searches = top_k(self.lattice, starts, k, seeds)
        ids = iter(self.ids([x.edges for s in searches for x in s.leaves]))
        return [
            [(next(ids), float(x.before[-1]), x.value, log_inclusion(float(x.before[-1]), s.threshold)) for x in s.leaves]
            for s in searches
        ]

    def sample(self, parts: list[str], k: int, seed: int) -> list[tuple[np.ndarray, float, float, float]]:
        """The same for one text."""
        return self.sample_all([parts], k, [seed])[0]


def lists(arrays: list[np.ndarray]) -> pa.ListArray:
    """Arrays of whole numbers as one column of lists."""
    ends = np.cumsum([0, *map(len, arrays)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int32), *arrays]), pa.int32()))


_SAMPLERS: dict[tuple, Sampler] = {}


def sampler(*how) -> Sampler:
    if how not in _SAMPLERS:
        _SAMPLERS[how] = Sampler(*how)
    return _SAMPLERS[how]


def row_seed(seed: int, key) -> int:
    return xxhash.xxh3_64_intdigest(f"{seed}:{key}")


def encode(
    docs: DataFrame, model_file: str, k: int, seed: int = 0, sharpness: float = 1.0, offset: float = 27.0,
    id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True,
) -> DataFrame:
    """Up to k rows per input row: doc_id, sample, [ids], n_pieces, ids_crc32, log_prob, perturbed, log_inclusion, inclusion, round_trip.

    sample counts from 1 in falling order of the perturbed value; the segmentations of a row are distinct. A text with
    fewer than k segmentations gives all of them with inclusion 1. Draws depend on seed, row id and text alone, so a
    repeated row repeats its samples, wherever and whenever it runs. Null and empty texts have one segmentation without
    pieces. Null ids are a key like any other. An empty table gives no rows; further columns are not read. round_trip
    says that decoding gives the text back, with the word mark character as a space. One narrow stage.
    """
    rows = documents(docs, id_col, text_col)
    names = ["sample", *["ids"] * with_ids, "n_pieces", "ids_crc32", "log_prob", "perturbed", "log_inclusion", "round_trip"]
    kinds = {"sample": T.IntegerType(), "ids": T.ArrayType(T.IntegerType()), "n_pieces": T.LongType(), "ids_crc32": T.LongType(),
             "round_trip": T.BooleanType()}
    schema = T.StructType([rows.schema["doc_id"], *[T.StructField(n, kinds.get(n, T.DoubleType())) for n in names]])
    arrow = {"sample": pa.int32(), "n_pieces": pa.int64(), "ids_crc32": pa.int64(), "round_trip": pa.bool_()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with_model = sampler(model_file, sharpness, offset)
        for batch in batches:
            texts, keys = marked(batch.column("text")), batch.column("doc_id").to_pylist()
            row, out = [], {n: [] for n in names}
            found = with_model.sample_from(with_model.starts(texts), k, [row_seed(seed, key) for key in keys])
            for at, samples in enumerate(found):
                for place, (ids, *numbers) in enumerate(samples, 1):
                    row.append(at)
                    plain = ids.astype("<u4")
                    values = [place, *[plain.astype(np.int32)] * with_ids, len(ids), zlib.crc32(plain.tobytes()), *numbers]
                    for n, v in zip(names[:-1], values, strict=True):
                        out[n].append(v)
            several = [ids for samples in found for ids, *_ in samples]
            out["round_trip"] = with_model.pieces.given_back(several, texts, row)
            columns = [lists(out[n]) if n == "ids" else pa.array(out[n], arrow.get(n, pa.float64())) for n in names]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(row, pa.int64())), *columns], ["doc_id", *names])

    return rows.mapInArrow(run, schema).withColumn("inclusion", F.exp("log_inclusion"))


def decode(encoded: DataFrame, model_file: str, ids_col: str = "ids", id_col: str = "doc_id") -> DataFrame:
    """doc_id, text of each row with ids; null ids of pieces give null, none give the empty text."""
    rows = encoded.select(F.col(id_col).alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = sampler(model_file, 1.0, 27.0).pieces
        for batch in batches:
            texts = [None if x is None else pieces.decode(x) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return rows.mapInArrow(run, T.StructType([rows.schema["doc_id"], T.StructField("text", T.StringType())]))
