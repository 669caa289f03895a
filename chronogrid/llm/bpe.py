"""Byte-pair encoding by a dynamic program over prefixes, and decoding.

Every prefix of a word has one encoding, so one last token.  A suffix automaton of
the vocabulary gives the tokens that end at each position; the last token is the
one that starts the word or is compatible with the last token of the prefix before
it, which a test of the pair alone decides.  Following the last tokens back from
the end of the word gives exactly the tokens that the ranked merges give.

The tokenizer's file is read on the driver; its tables (bounded by the vocabulary)
are broadcast.  Texts stream through in bounded Arrow batches without a shuffle.
"""

from __future__ import annotations

import json
import re
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrow import texts_as_bytes, with_arrow_columns
from .registry import register
from .suffix_automaton import SuffixAutomaton

#: Symbols are bytes; the last one of a word stands for its byte with the end-of-word suffix.
FINAL = 0x100
#: Bytes (about) of the stretches between blanks that a worker remembers with their tokens.
REMEMBERED_BYTES = 96 << 20
#: Pairs of tokens whose test a worker remembers: 9 bytes each.
REMEMBERED_PAIRS = 2_000_000
#: Words of up to so many symbols are encoded side by side, so many at a time (26 MB); longer ones by themselves.
SIDE_BY_SIDE, BLOCK = 64, 50_000
NEVER = 1 << 40
#: What keys of special tokens and of single words begin with; both are blanks to Python, so no stretch holds them.
SPECIAL, WORD = "\x1d", "\x1c"
#: The splitter's pattern (fixed by the tokenizer's definition).
SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")


def byte_symbols() -> dict[int, str]:
    """The printable character that stands for each byte: itself where Latin-1 prints it, else the next from U+0100."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) if b in plain else chr(256 + rest.index(b)) for b in range(256)}


class PrefixEncoder:
    """Encodes one word at a time; built from a tokenizer definition."""

    def __init__(self, definition: str):
        spec = json.loads(definition)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.words = {i: t for t, i in model["vocab"].items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        bytes_of = {c: b for b, c in byte_symbols().items()}
        inner = {self._symbols(t, bytes_of): i for t, i in model["vocab"].items()}
        merges = [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        #: pair of tokens -> rank of its merge
        self.rank: dict[tuple[int, int], int] = {}
        made: dict[tuple[int, int], int] = {}
        for r, (a, b) in enumerate(merges):
            left, right = self._symbols(a, bytes_of), self._symbols(b, bytes_of)
            pair = inner[left], inner[right]
            self.rank[pair], made[pair] = r, inner[left + right]
        self.size = {i: len(s) for s, i in inner.items()}
        # tokens that the merges reach, with the last merge that makes them
        self.parts: dict[int, tuple[int, int]] = {}
        ends: dict[str, int] = {}
        for s, i in sorted(inner.items(), key=lambda x: len(x[0])):
            row = [inner[c] for c in s]
            pair = None
            while len(row) > 1:
                r, at = min((self.rank.get(p, NEVER), k) for k, p in enumerate(zip(row, row[1:])))
                if r == NEVER:
                    break
                pair = row[at], row[at + 1]
                row[at:at + 2] = [made[pair]]
            if row == [i]:
                ends[s] = i
                if pair:
                    self.parts[i] = pair
        self._check_order()
        automaton = SuffixAutomaton()
        for s in ends:
            automaton.add(s)
        own: dict[int, list[tuple[int, int]]] = {}
        for s, i in ends.items():
            own.setdefault(automaton.states(s)[-1], []).append((len(s), i))
        self._tables(automaton, own)

    def _tables(self, automaton: SuffixAutomaton, own: dict[int, list[tuple[int, int]]]) -> None:
        """The automaton and the tokens that end at its states as arrays."""
        moves = sorted((state << 9 | ord(c), to) for state, step in enumerate(automaton.step) for c, to in step.items())
        self.moves, self.moved_to = (np.array(x, kind) for x, kind in zip(zip(*moves), (np.int64, np.int32)))
        self.link, self.length = np.array(automaton.link, np.int32), np.array(automaton.length, np.int32)
        # tokens that end where a state's match ends, the longest first
        ending: list[tuple[tuple[int, int], ...]] = [()] * len(automaton.link)
        for s in sorted(range(1, len(ending)), key=automaton.length.__getitem__):
            above = ending[automaton.link[s]]
            ending[s] = (*sorted(own[s], reverse=True), *above) if s in own else above
        self.ending_at = np.cumsum([0, *map(len, ending)], dtype=np.int64)
        self.ending = np.array([x for e in ending for x in e], np.int32).reshape(-1, 2)
        self.sizes = np.zeros(max(self.size) + 1, np.int32)
        self.sizes[list(self.size)] = list(self.size.values())

    def _symbols(self, token: str, bytes_of: dict[str, int]) -> str:
        body, final = (token[:-len(self.suffix)], FINAL) if self.suffix and token.endswith(self.suffix) else (token, 0)
        symbols = [bytes_of[c] for c in body]
        symbols[-1] += final
        return "".join(map(chr, symbols))

    def _check_order(self) -> None:
        for i, (a, b) in self.parts.items():
            if any(self.rank[self.parts[x]] >= self.rank[(a, b)] for x in (a, b) if x in self.parts):
                raise ValueError("a merge comes before the merges of its parts: pairs can't be tested alone")

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """What stands at one edge of a token over time: (token, rank of the merge that ends it)."""
        edge, until = [], NEVER
        while True:
            edge.append((token, until))
            if token not in self.parts:
                return edge
            until = self.rank[self.parts[token]]
            token = self.parts[token][side]

    def compatible(self, a: int, b: int) -> bool:
        """Whether no merge joins the neighbours a and b or parts of them across their border.

        A merge of their edges comes first if its rank is lower than those of the
        merges that use up either; of equal ranks, the leftmost comes first."""
        rank = self.rank.get
        for x, until_x in self.right(a):
            for y, until_y in self.left(b):
                r = rank((x, y), NEVER)
                if r < until_x and (r < until_y or r == until_y != NEVER):
                    return False
        return True

    def prepare(self) -> None:
        """What is remembered per worker."""
        self.left = lru_cache(maxsize=20_000)(lambda token: self._edge(token, 0))
        self.right = lru_cache(maxsize=20_000)(lambda token: self._edge(token, 1))
        self.pairs, self.fits = np.zeros(0, np.int64), np.zeros(0, bool)
        self.steps: dict[int, int] | None = None
        self.remembered = Remembered(self)

    def _compatible(self, pairs: np.ndarray) -> np.ndarray:
        """The test of many pairs (token before << 20 | token); each distinct pair is tested once."""
        at = np.searchsorted(self.pairs, pairs)
        known = at < len(self.pairs)
        known[known] = self.pairs[at[known]] == pairs[known]
        if not known.all():
            new = np.unique(pairs[~known])
            if len(self.pairs) > REMEMBERED_PAIRS:
                new, self.pairs, self.fits = np.unique(pairs), self.pairs[:0], self.fits[:0]
            tested = np.array([self.compatible(p >> 20, p & 0xFFFFF) for p in new.tolist()], bool)
            both = np.concatenate([self.pairs, new])
            order = np.argsort(both, kind="stable")
            self.pairs, self.fits = both[order], np.concatenate([self.fits, tested])[order]
            at = np.searchsorted(self.pairs, pairs)
        return self.fits[at]

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of many words in one array, and where each word's begin.

        The words stand side by side in order, and the dynamic program goes through them
        symbol by symbol: state and match length, then the last token, of every prefix.
        A prefix that the word before has too is not computed again."""
        order = np.array(sorted(range(len(words)), key=words.__getitem__), np.int64)
        size = np.array(list(map(len, words)), np.int64)[order]
        m, longest = len(words), int(size.max())
        symbols = np.zeros((m, longest), np.int16)
        within = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        symbols[np.repeat(np.arange(m), size), within] = np.frombuffer(b"".join(words[k] for k in order.tolist()), np.uint8)
        symbols[np.arange(m), size - 1] += FINAL if self.suffix else 0
        shared = np.zeros(m, np.int64)                              # symbols that a word begins with like the one before
        shared[1:] = np.cumprod(symbols[1:] == symbols[:-1], axis=1, dtype=np.int8).sum(axis=1)
        shared[1:] = np.minimum(shared[1:], np.minimum(size[1:], size[:-1]))
        last = np.zeros((m, longest + 1), np.int32)
        state, matched = np.zeros(m, np.int64), np.zeros(m, np.int32)
        for i in range(1, longest + 1):
            words_here = np.nonzero(size >= i)[0]
            new = shared[words_here] < i
            first = words_here[new]
            s, n, token = self._step(first, i, symbols[first, i - 1], state, matched, last)
            of = np.cumsum(new) - 1
            state[words_here], matched[words_here], last[words_here, i] = s[of], n[of], token[of]
        # back from the last token of each word
        rows, at, rounds = np.arange(m), size.copy(), []
        while len(rows):
            token = last[rows, at[rows]]
            rounds.append((rows, token))
            at[rows] -= self.sizes[token]
            rows = rows[at[rows] > 0]
        count = np.zeros(m, np.int64)
        for rows, _ in rounds:
            count[order[rows]] += 1
        begin = np.concatenate([[0], np.cumsum(count)])
        ids = np.zeros(int(begin[-1]), np.int32)
        for r, (rows, token) in enumerate(rounds):
            ids[begin[order[rows] + 1] - 1 - r] = token
        return ids, begin

    def _step(self, words: np.ndarray, i: int, symbol: np.ndarray, state: np.ndarray, matched: np.ndarray,
              last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """State, match length and last token of the words' prefixes of ``i`` symbols, the last one ``symbol``."""
        k = len(words)
        to, length = np.zeros(k, np.int64), np.zeros(k, np.int32)
        rows, s, n = np.arange(k), state[words], matched[words]
        while len(rows):
            move = s << 9 | symbol[rows]
            at = np.minimum(np.searchsorted(self.moves, move), len(self.moves) - 1)
            found = self.moves[at] == move
            to[rows[found]], length[rows[found]] = self.moved_to[at[found]], n[found] + 1
            if (s[~found] == 0).any():
                raise ValueError("a symbol has no token")
            rows, s = rows[~found], self.link[s[~found]].astype(np.int64)
            n = self.length[s]
        tokens, rows, at, end = np.zeros(k, np.int32), np.arange(k), self.ending_at[to], self.ending_at[to + 1]
        while len(rows):
            if (at[rows] >= end[rows]).any():
                raise ValueError("a prefix has no encoding")
            size, token = self.ending[at[rows], 0], self.ending[at[rows], 1]
            fits = (size == i) & (length[rows] >= i)
            inner = np.nonzero((size < i) & (size <= length[rows]))[0]
            before = last[words[rows[inner]], i - size[inner]].astype(np.int64)
            fits[inner] = self._compatible(before << 20 | token[inner])
            tokens[rows[fits]] = token[fits]
            rows = rows[~fits]
            at[rows] += 1
        return to, length, tokens

    def encode_long_word(self, word: bytes) -> np.ndarray:
        """The same for a word of any length: four bytes a symbol for the last tokens, and only the current state."""
        if self.steps is None:
            self.steps = dict(zip(self.moves.tolist(), self.moved_to.tolist()))
        steps, link, length, at, ending = self.steps, self.link.tolist(), self.length.tolist(), self.ending_at.tolist(), self.ending.tolist()
        last, state, n, fits = array("i", [0]), 0, 0, {}
        for i, c in enumerate(word, 1):
            if i == len(word) and self.suffix:
                c += FINAL
            while (to := steps.get(state << 9 | c)) is None:
                state = link[state]
                n = length[state]
            state, n = to, n + 1
            for k in range(at[state], at[state + 1]):
                size, token = ending[k]
                if size > n:
                    continue
                if size < i:
                    pair = last[i - size] << 20 | token
                    if pair not in fits:
                        if len(fits) > REMEMBERED_PAIRS // 10:
                            fits.clear()
                        fits[pair] = self.compatible(pair >> 20, token)
                    if not fits[pair]:
                        continue
                last.append(token)
                break
            else:
                raise ValueError("a prefix has no encoding")
        ids, i = array("i"), len(word)
        while i:
            ids.append(last[i])
            i -= self.size[last[i]]
        return np.array(ids, np.int32)[::-1]

    def encode(self, text: str, splitter: Pretokenizer) -> list[int]:
        """Token ids of a whole text."""
        codes = np.array([self.remembered[key] for key in splitter.keys(text)], np.int64)
        self.remembered.settle()
        ids = self.remembered.ids(codes)[0].tolist()
        self.remembered.trim(codes)
        return ids


class Remembered(dict):
    """Stretches of text -> code; per code its tokens (in one flat array) and what they decode to.

    A batch of texts is a list of codes: every distinct stretch is encoded once, and ids
    and decoded texts are put together from the tables.  Beyond ``REMEMBERED_BYTES`` the
    stretches used most stay."""

    def __init__(self, encoder: PrefixEncoder):
        super().__init__()
        self.encoder = encoder
        self.flat, self.starts, self.decoded, self.bytes = array("i"), array("q", [0]), [], 0
        self.uses, self.pending = np.zeros(0, np.int64), []

    def __missing__(self, key: str) -> int:
        """A new stretch's code; ``settle`` encodes it with the others of its batch."""
        code = self[key] = len(self.starts) - 1 + len(self.pending)
        self.pending.append(key)
        return code

    def settle(self) -> None:
        """Encodes the stretches that are new: each of their words once."""
        keys, self.pending = self.pending, []
        for k in range(0, len(keys), BLOCK):
            self._settle(keys[k:k + BLOCK])

    def _settle(self, keys: list[str]) -> None:
        place: dict[bytes, int] = {}
        parts: list[np.ndarray] = []                    # tokens given without the program, numbered from -2 down
        words, ends = array("q"), array("q")
        for key in keys:
            if key[0] == SPECIAL:
                parts.append(np.array([self.encoder.specials[key[1:]]], np.int32))
                words.append(-1 - len(parts))
            else:
                for w in [key[1:]] if key[0] == WORD else SPLIT.findall(key):
                    raw = w.encode()
                    if len(raw) > SIDE_BY_SIDE:
                        parts.append(self.encoder.encode_long_word(raw))
                        words.append(-1 - len(parts))
                    else:
                        words.append(place.setdefault(raw, len(place)))
            ends.append(len(words))
        ids, begin = self.encoder.encode_words(list(place)) if place else (np.zeros(0, np.int32), np.zeros(1, np.int64))
        begin = np.concatenate([begin, begin[-1] + np.cumsum([len(p) for p in parts], dtype=np.int64)]) if parts else begin
        ids = np.concatenate([ids, *parts])
        number = np.array(words, np.int64)
        number[number < 0] = len(place) - 2 - number[number < 0]
        first, n = begin[number], begin[number + 1] - begin[number]
        flat = ids[np.repeat(first - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]
        upto = np.concatenate([[0], np.cumsum(n)])[np.array(ends, np.int64)]
        base, name, listed, at = len(self.flat), self.encoder.words.__getitem__, flat.tolist(), 0
        for key, end in zip(keys, upto.tolist()):
            text = " ".join(map(name, listed[at:end]))
            self.decoded.append(text)
            self.bytes += 260 + len(key) + len(text) + 6 * (end - at)
            at = end
        self.flat.frombytes(flat.astype(np.int32).tobytes())
        self.starts.frombytes((upto + base).astype(np.int64).tobytes())

    def ids(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of a row of codes, and how many each code has."""
        starts = np.array(self.starts, np.int64)
        begin, n = starts[codes], starts[codes + 1] - starts[codes]
        at = np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        return np.array(self.flat, np.int32)[at], n

    def trim(self, codes: np.ndarray) -> None:
        """Counts what a batch used; when too much is remembered, the half used most stays."""
        uses = np.bincount(codes, minlength=len(self.decoded))
        uses[:len(self.uses)] += self.uses
        self.uses = uses
        if self.bytes <= REMEMBERED_BYTES:
            return
        order = np.argsort(-uses, kind="stable")[:len(uses) // 2]
        keys, old = list(self), (self.flat, self.starts, self.decoded)
        self.clear()
        self.flat, self.starts, self.decoded, self.bytes = array("i"), array("q", [0]), [], 0
        for k in sorted(order.tolist()):
            ids, size = old[0][old[1][k]:old[1][k + 1]], 260 + len(keys[k]) + len(old[2][k])
            size += 6 * len(ids)
            if self.bytes + size > REMEMBERED_BYTES // 2:
                continue
            self[keys[k]] = len(self.decoded)
            self.flat.extend(ids)
            self.starts.append(len(self.flat))
            self.decoded.append(old[2][k])
            self.bytes += size
        self.uses = np.zeros(len(self.decoded), np.int64)


class Pretokenizer:
    """Words of a text as the tokenizer's normaliser and splitter give them.

    Texts of letters below U+0250 are cut at blanks and split by ``SPLIT``; for others
    the definition's own normaliser and splitter are asked, so rare letters follow its
    Unicode tables."""

    RARE = re.compile("[^\x00-\x1b\x20-\u024f]")  # 1C-1F: blanks to Python, not to the tokenizer

    def __init__(self, definition: str, specials: dict[str, int]):
        self.definition, self.tokenizer = definition, None
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(specials, key=len, reverse=True))) + ")")
        self.symbols = {ord(c): b for b, c in byte_symbols().items()}

    def words(self, text: str) -> list[str]:
        if self.tokenizer is None:
            from tokenizers import Tokenizer
            self.tokenizer = Tokenizer.from_str(self.definition)
        found = self.tokenizer.pre_tokenizer.pre_tokenize_str(self.tokenizer.normalizer.normalize_str(text))
        return [bytes(self.symbols[ord(c)] for c in w).decode() for w, _ in found]

    def keys(self, text: str) -> list[str]:
        """What a text is encoded by, in order: stretches between blanks, special tokens, words of rare letters."""
        if "<|" not in text and not self.RARE.search(text):
            return text.lower().split()
        out: list[str] = []
        for k, piece in enumerate(self.special.split(text)):   # special tokens at odd places
            if k % 2:
                out.append(SPECIAL + piece)
            elif self.RARE.search(piece):
                out += [WORD + w for w in self.words(piece)]
            else:
                out += piece.lower().split()
        return out


def with_tokens(docs: DataFrame, tokenizer_path: str, text_col: str = "text", ids: str = "token_ids",
                decoded: str | None = None, without: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` less ``without``, plus the token ids of each whole text (array of int).

    The tokenizer is a BPE definition in JSON with an end-of-word suffix.  Special
    tokens in a text count as such; none are added, nothing is cut or padded.  With
    ``decoded``, a column of that name holds the tokens of the ids joined by blanks,
    as the definition (which names no decoder) decodes them.  Null and empty texts
    have no ids and decode to the empty text.  Repeated rows each come back; an
    empty table gives no rows."""
    with open(tokenizer_path, encoding="utf-8") as f:
        definition = f.read()
    encoder = PrefixEncoder(definition)
    shared = docs.sparkSession.sparkContext.broadcast((encoder, Pretokenizer(definition, encoder.specials)))

    def start():
        encoder, splitter = shared.value
        encoder.prepare()
        table = encoder.remembered
        code_of = table.__getitem__

        def compute(batch: pa.RecordBatch) -> list[pa.Array]:
            rows = []
            for raw in texts_as_bytes(batch, text_col):
                keys = splitter.keys((raw or b"").decode())
                rows.append(array("i", map(code_of, keys)))
            lengths = np.array([len(r) for r in rows], np.int64)
            table.settle()
            codes = np.frombuffer(b"".join(rows), np.int32)
            values, n = table.ids(codes)
            total = np.concatenate([[0], np.cumsum(n)])
            ends = total[np.concatenate([[0], np.cumsum(lengths)])]
            out: list[pa.Array] = [pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(values))]
            if decoded:
                text_of, empty = table.decoded.__getitem__, not n.all()
                out.append(pa.array([" ".join(filter(None, map(text_of, r)) if empty else map(text_of, r)) for r in rows], pa.string()))
            table.trim(codes)
            return out
        return compute

    fields = [(ids, T.ArrayType(T.IntegerType()))] + [(decoded, T.StringType())] * bool(decoded)
    return with_arrow_columns(docs, start, fields, without)


def public_tokenizer(name: str) -> str:
    """Where a public tokenizer's file lies."""
    import public_tokenizers
    return public_tokenizers.path(name)


@register("op7_bpe")
def op7_bpe(spark: SparkSession, sf_dir: str, tokenizer_path: str | None = None) -> DataFrame:
    """Token count and digests of the ids and of the decoded text of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    path = tokenizer_path or public_tokenizer("word_bpe_49k.json")
    return with_tokens(docs, path, decoded="decoded", without=("text",)).select(
        "doc_id", F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("token_ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
