"""BPE encoding and decoding by a tokenization automaton.

The merges are compiled, in order, into one deterministic automaton over tokens
that accepts exactly the tokenizations BPE gives. It starts as one state with a
loop for every base symbol. The gadget of a merge (u, v) -> w takes the arc v
away from the state that u leads to (a copy of it, if other tokens lead there
too) and gives an arc w to every state that has an arc u. All arcs of a token
lead to one state, so there are fewer states than tokens.

A state is kept as what it has lost: its own lost arcs, each with the merge that
took it, and the state it was copied from. Whether a state has the arc w follows
from w's left parts: the arc was given if the arc of the left part was there when
the merge was compiled.

A pre-split word is encoded by running the automaton over the tokens a trie of
the vocabulary finds at each place; exactly one path reaches each place, because
each beginning of a word has one tokenization. Decoding joins the labels of the
arcs. The work is linear in the word's length, however long the word.

Texts are normalised and split into words by the library's own normaliser and
splitter, the part of the tokenizer that comes before its merges, so that letters and
digits are what they are to it, in every version of Unicode.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from tokenizers import Tokenizer

from labelmill.llm.common import pieces
from labelmill.llm.words import Parts, parts_at_blanks

NEVER = 1 << 60
START = 0
#: Entries of derived states that a task may remember, some 100 bytes each.
MOST_LOST = 200_000
#: Slots of the table of arcs, 9 bytes each; half of them are used.
ARC_SLOTS = 1 << 20
#: Longest word, in signs, that runs side by side with others.
SIDE_BY_SIDE = 48
MEMO_BYTES = 32 << 20


class Automaton:
    """The compiled merges: plain lists and dicts, bounded by the vocabulary, that travel to the tasks."""

    def __init__(self, vocabulary: dict[str, int], merges: list[tuple[str, str]], word_end: str = ""):
        self.vocabulary, self.word_end = vocabulary, word_end
        numbered = [(vocabulary[u], vocabulary[v], vocabulary[u + v]) for u, v in merges]
        made = {w for _, _, w in numbered}
        self.target = {t: START for t in vocabulary.values() if t not in made}
        self.own: list[dict[int, int]] = [{}]
        self.taken: set[int] = set()
        self.lost: dict[int, int] = {}
        self.source, self.since = [-1], [NEVER]
        self.left: dict[int, tuple[int, int]] = {}
        # the start is entered by reading nothing, too, so it never loses an arc itself
        entering = [len(self.target) + 1]
        for time, (u, v, w) in enumerate(numbered):
            before = self.target.get(u)
            if before is None or v not in self.target or not self.has_arc(before, v):
                continue  # no tokenization ever puts v after u
            after = before
            if entering[before] > 1 or u == v:
                after = len(self.own)
                self.own.append({})
                self.source.append(before)
                self.since.append(time)
                entering[before] -= 1
                entering.append(1)
                self.target[u] = after
            self.own[after][v] = time
            self.taken.add(v)
            self.lost.clear()
            self.left[w] = (u, time)
            # after w stands what stood after v; u u u is read as w u, so w keeps the old state
            self.target[w] = before if u == v else self.target[v]
            entering[self.target[w]] += 1

    def _lost(self, state: int, token: int) -> int:
        """When the state lost its arc for the token, itself or before it was copied; NEVER if it did not."""
        if token not in self.taken:
            return NEVER
        if len(self.lost) > MOST_LOST:
            self.lost.clear()
        asked, known = [], None
        while known is None and state >= 0:
            known = self.lost.get(state << 20 | token)
            if known is None:
                asked.append(state)
                state = self.source[state]
        found = NEVER if known is None else known
        for state in reversed(asked):
            # what was lost after the copy was made is not lost to the copy
            inherited = found if found <= self.since[state] else NEVER
            found = min(self.own[state].get(token, NEVER), inherited)
            self.lost[state << 20 | token] = found
        return found

    def has_arc(self, state: int, token: int) -> bool:
        time = NEVER - 1
        while True:
            if self._lost(state, token) <= time:
                return False
            if token not in self.left:
                return True
            token, given = self.left[token]
            time = min(time, given)


class Table:
    """Whole numbers by whole numbers: a hash table in flat arrays, asked for many keys at a time."""

    def __init__(self, slots: int, kind: str = "i4"):
        self.keys, self.values = np.full(slots, -1, np.int64), np.zeros(slots, kind)
        self.mask, self.used = slots - 1, 0

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(40)).astype(np.int64) & self.mask

    def put(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Add keys, each once and new."""
        slots = self._slots(keys)
        self.used += len(keys)
        while len(keys):
            free = self.keys[slots] == -1
            self.keys[slots[free]] = keys[free]
            mine = self.keys[slots] == keys
            self.values[slots[mine]] = values[mine]
            keys, values, slots = keys[~mine], values[~mine], (slots[~mine] + 1) & self.mask

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The values of keys, -1 where a key is not there."""
        out = np.full(len(keys), -1, self.values.dtype)
        slots, at = self._slots(keys), np.arange(len(keys))
        while len(at):
            held = self.keys[slots]
            hit = held == keys
            out[at[hit]] = self.values[slots[hit]]
            on = ~hit & (held != -1)
            keys, at, slots = keys[on], at[on], (slots[on] + 1) & self.mask
        return out

    def clear(self) -> None:
        self.keys[:] = -1
        self.used = 0


class WordEncoder:
    """Runs an automaton over words, many side by side, with the vocabulary as a trie; all tables are flat."""

    def __init__(self, automaton: Automaton):
        self.automaton = automaton
        # from a node by a sign to the next node; the token that ends at a node inside a word, and the one that ends there at the word's end
        edges: dict[int, int] = {}
        inner, closing = array("i", [-1]), array("i", [-1])
        end = automaton.word_end
        for name, token in automaton.vocabulary.items():
            if token in automaton.target:
                closes = bool(end) and name.endswith(end)
                node = 0
                for sign in name[: len(name) - len(end)] if closes else name:
                    key = node << 21 | ord(sign)
                    if key not in edges:
                        edges[key] = len(inner)
                        inner.append(-1)
                        closing.append(-1)
                    node = edges[key]
                if not closes:
                    inner[node] = token
                if closes or not end:
                    closing[node] = token
        self.edges = Table(1 << max(4, (4 * len(edges)).bit_length()))
        self.edges.put(np.fromiter(edges.keys(), np.int64, len(edges)), np.fromiter(edges.values(), np.int32, len(edges)))
        self.inner, self.closing = np.array(inner, np.int32), np.array(closing, np.int32)
        self.target = np.full(max(automaton.vocabulary.values()) + 1, -1, np.int32)
        self.target[list(automaton.target.keys())] = list(automaton.target.values())
        self.arcs = Table(ARC_SLOTS, "i1")

    def has_arcs(self, states: np.ndarray, tokens: np.ndarray) -> np.ndarray:
        """Whether the states have arcs for the tokens, from the table; what is not there yet is derived and added."""
        keys = states.astype(np.int64) << 20 | tokens
        found = self.arcs.get(keys)
        if (found < 0).any():
            new = np.unique(keys[found < 0])
            if self.arcs.used + len(new) > ARC_SLOTS // 2:
                self.arcs.clear()
            told = np.fromiter((self.automaton.has_arc(k >> 20, k & 0xFFFFF) for k in new.tolist()), np.int8, len(new))
            missing = found < 0
            found[missing] = told[np.searchsorted(new, keys[missing])]
            if len(new) <= ARC_SLOTS // 2:
                self.arcs.put(new, told)
        return found > 0

    def encode(self, word: str) -> list[int]:
        """Ids of one pre-split word, its signs already those of the vocabulary."""
        return np.frombuffer(self.encode_all([word])[0], np.int32).tolist()

    def encode_all(self, words: list[str]) -> list[bytes]:
        """Ids of pre-split words, as 32-bit bytes. Words run side by side with those of about their length."""
        out: list[bytes] = [b""] * len(words)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(sizes, kind="stable")
        order = order[sizes[order] > 0]
        for low, high in ((1, 8), (9, 16), (17, SIDE_BY_SIDE)):
            some = order[(sizes[order] >= low) & (sizes[order] <= high)]
            for a in range(0, len(some), 16_384):
                here = some[a : a + 16_384].tolist()
                for k, ids in zip(here, self._run([words[k] for k in here], sizes[here])):
                    out[k] = ids
        for k in order[sizes[order] > SIDE_BY_SIDE].tolist():
            out[k] = self._run_long(words[k])
        return out

    def _run(self, words: list[str], sizes: np.ndarray) -> list[bytes]:
        longest = int(sizes.max())
        signs = np.zeros((len(words), longest), np.int64)
        flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        signs[np.repeat(np.arange(len(words)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
        states = np.full((len(words), longest + 1), -1, np.int32)
        states[:, 0] = START
        tokens, comes_from = np.zeros_like(states), np.zeros_like(states)
        for i in range(longest):
            at = np.flatnonzero((states[:, i] >= 0) & (sizes > i))
            node = np.zeros(len(at), np.int64)
            for j in range(i + 1, longest + 1):
                on = sizes[at] >= j
                at, node = at[on], node[on]
                node = self.edges.get(node << 21 | signs[at, j - 1]).astype(np.int64)
                at, node = at[node >= 0], node[node >= 0]
                if not len(at):
                    break
                token = np.where(sizes[at] == j, self.closing[node], self.inner[node])
                # one path reaches a place: where one has come no other needs to be tried
                ends = np.flatnonzero((token >= 0) & (states[at, j] < 0))
                if i and len(ends):  # no arc of the start is ever lost
                    ends = ends[self.has_arcs(states[at[ends], i], token[ends])]
                states[at[ends], j] = self.target[token[ends]]
                tokens[at[ends], j] = token[ends]
                comes_from[at[ends], j] = i
        # back from the ends; the last token comes first
        steps, at, place = [], np.arange(len(words)), sizes.copy()
        while len(at):
            row = np.full(len(words), -1, np.int32)
            row[at] = tokens[at, place]
            steps.append(row)
            place = comes_from[at, place].astype(np.int64)
            at, place = at[place > 0], place[place > 0]
        ids = np.stack(steps[::-1], axis=1)
        counts = (ids >= 0).sum(axis=1)
        data, ends = ids[ids >= 0].tobytes(), np.cumsum(counts) * 4
        return [data[a:b] for a, b in zip([0, *ends.tolist()], ends.tolist())]

    def _run_long(self, word: str) -> bytes:
        """One word by itself: the paths' states at its places, from the front."""
        n, last = len(word), len(word) - 1
        signs = np.frombuffer(word.encode("utf-32-le"), np.uint32).astype(np.int64)
        states = np.full(n + 1, -1, np.int64)
        states[0] = START
        tokens, comes_from = np.zeros(n + 1, np.int32), np.zeros(n + 1, np.int64)
        for i in range(n):
            if states[i] < 0:
                continue
            node, j, met = 0, i, []
            while j <= last:
                node = int(self.edges.get(np.array([node << 21 | int(signs[j])]))[0])
                if node < 0:
                    break
                j += 1
                token = int(self.inner[node] if j <= last else self.closing[node])
                if token >= 0 and states[j] < 0:
                    met.append((j, token))
            if met:
                has = self.has_arcs(np.full(len(met), states[i]), np.array([t for _, t in met])) if i else np.ones(len(met), bool)
                for (j, token), yes in zip(met, has.tolist()):
                    if yes:
                        states[j], tokens[j], comes_from[j] = self.target[token], token, i
        out = array("i")
        while n:
            out.append(int(tokens[n]))
            n = int(comes_from[n])
        out.reverse()
        return out.tobytes()


def read_tokenizer(path: str) -> dict:
    """What a tokenizer file says, read once on the driver: vocabulary, merges, word end, special tokens, and ``front``, the file without its vocabulary.

    Refuses what the automaton is not made for: other models than plain BPE, special
    tokens that look at what stands around them, blanks that mean something.
    """
    with open(path, encoding="utf-8") as file:
        said = json.load(file)
    model = said["model"]
    if model["type"] != "BPE" or any(model.get(x) for x in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges")):
        raise ValueError("not a plain BPE model")
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in said["added_tokens"]):
        raise ValueError("special tokens that depend on what stands around them")
    front = json.dumps({**said, "added_tokens": [], "truncation": None, "padding": None, "post_processor": None, "model": {"type": "BPE", "vocab": {}, "merges": []}})
    opened = Tokenizer.from_str(front)
    if not parts_at_blanks(lambda text: words_of(opened, text)):
        raise ValueError("blanks mean something: texts cannot be coded word by word")
    return {
        "vocabulary": model["vocab"], "merges": [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]],
        "word_end": model.get("end_of_word_suffix") or "", "special": {t["content"]: t["id"] for t in said["added_tokens"]}, "front": front,
    }


def words_of(front: Tokenizer, text: str) -> list[str]:
    """The words of a text, in the signs of the vocabulary, as the tokenizer splits it before its merges."""
    if front.normalizer is not None:
        text = front.normalizer.normalize_str(text)
    return [word for word, _ in front.pre_tokenizer.pre_tokenize_str(text)]


class TextEncoder(Parts):
    """Normalise, split at blanks and into words, encode each word, and the way back."""

    def __init__(self, automaton: Automaton, front: str, special: dict[str, int]):
        self.encoder = WordEncoder(automaton)
        self.front = Tokenizer.from_str(front)
        self.special = {text: array("i", [i]).tobytes() for text, i in special.items()}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        self.labels = {i: name for name, i in automaton.vocabulary.items()} | {i: name for name, i in special.items()}
        super().__init__(MEMO_BYTES)

    def words(self, words: list[str]) -> list[bytes]:
        return self.encoder.encode_all(words)

    def whole(self, parts: list[str]) -> list[bytes]:
        """Ids of any texts: special tokens where their strings stand, words between them."""
        split = [[p for p in (self.cut.split(part) if self.cut else [part]) if p] for part in parts]
        found = [[[p] if p in self.special else words_of(self.front, p) for p in pieces_of] for pieces_of in split]
        asked = list({w: None for of_part, ws in zip(split, found) for p, some in zip(of_part, ws) if p not in self.special for w in some})
        known = dict(zip(asked, self.encoder.encode_all(asked)))
        return [b"".join(self.special[p] if p in self.special else b"".join(known[w] for w in some) for p, some in zip(of_part, ws)) for of_part, ws in zip(split, found)]

    def encode(self, text: str) -> list[int]:
        return list(array("i", next(self.texts(pa.array([text])))))

    def decode(self, ids: list[int]) -> str:
        return " ".join(map(self.labels.__getitem__, ids))


#: The encoder of a worker process, by name: what it has derived serves its next tasks, too. Never more than one.
_KEPT: dict[str, TextEncoder] = {}


def _encoder(name: str, shared: Broadcast) -> TextEncoder:
    if name not in _KEPT:
        _KEPT.clear()
        _KEPT[name] = TextEncoder(*shared.value)
    return _KEPT[name]


def encode(docs: DataFrame, tokenizer: str, text_column: str = "text") -> DataFrame:
    """``docs`` with its own columns and token_ids, decoded.

    Encodes whole texts as the tokenizer file asks without adding special tokens;
    the strings of special tokens in a text are those tokens. Null and empty
    texts give no ids and an empty decoded text. Rows stay one for one, repeated
    ones too, in any order; an empty table stays empty. Columns of ``docs`` named
    token_ids or decoded are replaced.
    """
    said = read_tokenizer(tokenizer)
    compiled = Automaton(said["vocabulary"], said["merges"], said["word_end"])
    shared = docs.sparkSession.sparkContext.broadcast((compiled, said["front"], said["special"]))
    name = hashlib.md5(json.dumps([said["vocabulary"], said["merges"], said["front"], said["special"]]).encode()).hexdigest()
    added = StructType.fromDDL("token_ids array<int>, decoded string")
    rest = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in added.names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(name, shared)
        for whole in batches:
            for batch in pieces(whole, text_column):
                column = batch.column(batch.schema.get_field_index(text_column))
                ids = list(encoder.texts(column.fill_null("")))
                offsets = np.concatenate([[0], np.cumsum([len(x) // 4 for x in ids])]).astype(np.int32)
                flat = np.frombuffer(b"".join(ids), np.int32)
                decoded = pa.array((encoder.decode(array("i", x)) for x in ids), pa.string())
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)), decoded], names=[*batch.schema.names, *added.names]
                )

    return rest.mapInArrow(run, StructType(rest.schema.fields + added.fields))
