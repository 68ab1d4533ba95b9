"""BPE encoding and decoding as streaming transducers.

Encoding. Merging by rank can change an earlier token only through a chain of merges of falling urgency, each
reaching further left than the one before: the rule (u, v) can be set off by a change inside v only if v
begins with the left part of an earlier rule of the chain. The longest such chain, measured by the lengths of
its left parts, is computed from the merge list once (:attr:`Merges.lookahead`). A token that ends that far
before the end of what has been read can no longer change, so it is emitted and forgotten; what is held is a
constant amount of text, however long a word is. Every word goes through this stream; the tokens that a word of up to
REMEMBERED characters has emitted are kept in a bounded cache, so that the next one like it is looked up.

Decoding is a state machine over bytes: each token adds its surface bytes, complete characters leave at once,
and at most three bytes of an unfinished one are held. The digests of a text hash what this machine makes of the
emitted ids, a run at a time; texts are cut into stretches, so that beside the text itself only one stretch's words
are held. A stretch ends at a blank, or, where none follows soon, inside a run without blanks at a character that
normalisation doesn't touch: the stream then reads its word on from the next stretch. Only a run of combining marks or
of apostrophes has no such place, and is held as a whole.

The normalisation and word rules are those of the vocabulary file's own pipeline: NFC, white space to blanks,
lower case, contractions, letter runs, single digits, other runs; each word's last byte is marked as its end.
Special tokens in a text are found before all that, as in the file.

Edge cases: a null text counts as empty and gives no tokens and an empty decoded text; null ids are kept;
other columns are ignored by :func:`encode_digests`; an empty table gives an empty result.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import itertools
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import blank_if_null, named

END = "</w>"
#: The vocabulary's word pattern.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+")
#: Characters on which str.split and the vocabulary's white space disagree.
_CONTROLS = re.compile("[\x1c-\x1f]")
CACHE = 400_000
REMEMBERED = 200
#: Stretches of a text end at the first of these after so many characters: no normalisation or word goes beyond one.
_BLANK = re.compile("[\t-\r ]")
STRETCH = 1 << 16
#: Where a stretch may also end: before what composes with nothing before it, and not inside what may be a contraction.
_INSIDE = regex.compile(r"(?<!')(?<!'.)[^\p{M}\u1160-\u11ff]", regex.DOTALL)
#: What goes on with a run of letters, and with a run of other signs, that reached the end of a stretch.
_LETTERS, _OTHERS = regex.compile(r"[\p{L}]+"), regex.compile(r"[^\p{White_Space}\p{L}\p{N}]+")
#: Lists up to this length are merged without a queue.
_SHORT = 48
_NONE = 1 << 62


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


class Merges:
    """Merge rules by ids, the ids of single bytes, and the lookahead that the rules need."""

    def __init__(self, vocab: dict[str, int], merges: list, specials: dict[str, int]) -> None:
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
        symbols = byte_symbols()
        self.inner = [vocab[s] for s in symbols]
        self.last = [vocab[s + END] for s in symbols]
        self.tokens = {i: s for s, i in vocab.items()} | {i: s for s, i in specials.items()}
        self.specials = specials
        self.rules = {(vocab[u], vocab[v]): (rank, vocab[u + v]) for rank, (u, v) in enumerate(pairs)}
        self._codes = {p: rank << 32 | made for p, (rank, made) in self.rules.items()}
        self.lookahead = self._reach()
        self.lengths = {i: len(s.removesuffix(END)) for i, s in self.tokens.items()}
        self.longest = max(self.lengths.values())
        self.spelled = [self.tokens[i].encode() if i in self.tokens else b"" for i in range(max(self.tokens) + 1)]

    def _reach(self) -> int:
        length = {i: 1 for i in (*self.inner, *self.last)}
        left_parts: dict[int, list[int]] = {i: [i] for i in length}
        best: dict[int, int] = {}
        reach = 0
        for (u, v), (_, made) in self.rules.items():  # in order of rank
            if made not in length:
                length[made] = length[u] + length[v]
                left_parts[made] = [made, *left_parts[u]]
            far = length[u] + max((best.get(x, 0) for x in left_parts[v]), default=0)
            best[u] = max(best.get(u, 0), far)
            reach = max(reach, far)
        return reach

    def merge(self, ids: list[int]) -> list[int]:
        """All merges over a list, most urgent and leftmost first."""
        if len(ids) > _SHORT:
            return self._merge_long(ids)
        find = self._codes.get
        codes = [find(p, _NONE) for p in zip(ids, ids[1:], strict=False)]
        while codes:
            best = min(codes)
            if best == _NONE:
                break
            at = codes.index(best)
            ids[at : at + 2] = [best & 0xFFFFFFFF]
            del codes[at]
            if at:
                codes[at - 1] = find((ids[at - 1], ids[at]), _NONE)
            if at < len(codes):
                codes[at] = find((ids[at], ids[at + 1]), _NONE)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same over links and a queue of pairs."""
        rules, n = self.rules, len(ids)
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        queue = [(*rules[p], i) for i, p in enumerate(zip(ids, ids[1:], strict=False)) if p in rules]
        queue = [(rank, i, made) for rank, made, i in queue]
        heapq.heapify(queue)
        while queue:
            rank, i, made = heapq.heappop(queue)
            j = after[i]
            if ids[i] < 0 or j < 0 or rules.get((ids[i], ids[j])) != (rank, made):
                continue  # one side has been merged since
            ids[i], ids[j] = made, -1
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y >= 0 and (rule := rules.get((ids[x], ids[y]))):
                    heapq.heappush(queue, (rule[0], x, rule[1]))
        return [t for t in ids if t >= 0]

    def stream(self, symbols: Iterable[int], room: int = 1024) -> Iterator[int]:
        """Tokens of one word of any length, each as soon as it is stable; holds at most lookahead + room + a token."""
        held: list[int] = []
        for s in symbols:
            held.append(s)
            if len(held) >= self.lookahead + room + self.longest:
                stable, done, out = len(held) - self.lookahead, 0, []
                for t in self.merge(list(held)):
                    if done + self.lengths[t] > stable:
                        break
                    done += self.lengths[t]
                    out.append(t)
                yield from out
                del held[:done]
        yield from self.merge(held)

    def word(self, text: str) -> list[int]:
        """Tokens of one word, as the stream emits them."""
        data = text.encode("utf-8", "surrogatepass")
        inner = self.inner
        return list(self.stream(itertools.chain((inner[b] for b in data[:-1]), (self.last[data[-1]],))))


def load(path: str) -> Merges:
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    return Merges(spec["model"]["vocab"], spec["model"]["merges"], {t["content"]: t["id"] for t in spec["added_tokens"]})


class TextMachine:
    """Bytes to text, a piece at a time; an unfinished character waits for its next bytes."""

    def __init__(self) -> None:
        self._decoder = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, data: bytes) -> str:
        return self._decoder.decode(data)

    def finish(self) -> str:
        return self._decoder.decode(b"", True)


class Codec:
    """Texts to tokens and back, with a bounded cache of words."""

    def __init__(self, merges: Merges, cache: int = CACHE) -> None:
        self.merges = merges
        self._cache, self._words, self._parts = cache, {}, {}
        self._same = list(range(len(merges.spelled)))  # one object for each id, shared by the cached words
        self._special = re.compile("(" + "|".join(re.escape(s) for s in sorted(merges.specials, key=len, reverse=True)) + ")") if merges.specials else None

    @staticmethod
    def normal(text: str) -> str:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return text.lower()

    def words(self, text: str) -> list[str]:
        """Blank-free pieces of a normalised text: no word of the pattern goes beyond one."""
        text = self.normal(text)
        return WORDS.findall(text) if _CONTROLS.search(text) else text.split()

    def _piece(self, piece: str) -> list[int]:
        return [i for word in WORDS.findall(piece) for i in self._word(word)]

    def _word(self, word: str) -> list[int]:
        ids = self._parts.get(word)
        if ids is None:
            ids = self.merges.word(word)
            if len(word) <= REMEMBERED:
                if len(self._parts) >= self._cache:
                    self._parts.clear()
                self._parts[word] = ids
        return ids

    def _joined(self, parts: Iterator[tuple[str, bool]]) -> Iterator[list[int]]:
        """Runs of ids of words in parts: a word that ends in its part is looked up, another streamed over its parts."""
        for part, ends in parts:
            yield from [self._word(part)] if ends else map(list, itertools.batched(self.merges.stream(self._symbols(part, parts)), 4096))

    def _symbols(self, part: str, parts: Iterator[tuple[str, bool]]) -> Iterator[int]:
        """Symbols of a word that begins with `part` and goes on in the next ones, taken from `parts` when wanted."""
        inner, data, ends = self.merges.inner, part.encode("utf-8", "surrogatepass"), False
        while not ends:
            part, ends = next(parts)
            more = part.encode("utf-8", "surrogatepass")
            if more:
                yield from map(inner.__getitem__, data)
                data = more
        yield from map(inner.__getitem__, data[:-1])
        yield self.merges.last[data[-1]]

    def sections(self, text: str) -> Iterator[tuple[bool, Iterator[str]]]:
        """(whether it is a special token, its text in stretches that join) for each part of a text, in order.

        The stretches of one part are to be read before the next part is asked for.
        """
        at = 0
        for found in self._special.finditer(text) if self._special else ():
            yield from ((False, x) for x in _joining(_stretches(text, at, found.start())))
            yield True, iter((found[0],))
            at = found.end()
        yield from ((False, x) for x in _joining(_stretches(text, at, len(text))))

    def pieces(self, text: str, step: int = 4096) -> Iterator[list[tuple[int, str, tuple[int, ...]]]]:
        """Runs of (number of ids, ids as text, ids), one for each piece of the text, in order."""
        for special, section in self.sections(text):
            first = next(section)
            if special:
                made = self.merges.specials[first]
                yield [(1, str(made), (made,))]
                continue
            if (second := next(section, None)) is not None:
                for ids in self._joined(_parts(map(self.normal, itertools.chain((first, second), section)))):
                    yield [(len(ids), " ".join(map(str, ids)), tuple(ids))]
                continue
            words = self.words(first)
            for at in range(0, len(words), step):
                run = words[at : at + step]
                said = list(map(self._words.get, run))
                if None in said:
                    said = [s or self._learn(w) for s, w in zip(said, run, strict=True)]
                yield said

    def _learn(self, piece: str) -> tuple[int, str, tuple[int, ...]]:
        said = self._words.get(piece)
        if said is None:
            ids = self._piece(piece)
            said = len(ids), " ".join(map(str, ids)), tuple(map(self._same.__getitem__, ids))
            if len(piece) <= REMEMBERED:
                if len(self._words) >= self._cache:
                    self._words.clear()
                self._words[piece] = said
        return said

    def encode(self, text: str | None) -> list[int]:
        return [i for run in self.pieces(text or "") for _, _, ids in run for i in ids]

    def decode(self, ids: Iterable[int]) -> Iterator[str]:
        """The text of the tokens' surfaces, piece by piece: bytes of each token, blanks at word ends."""
        of = {s: b for b, s in enumerate(byte_symbols())}
        machine = TextMachine()
        for i in ids:
            token = self.merges.tokens[i]
            if token in self.merges.specials:
                yield machine.feed(token.encode())
                continue
            surface = bytes(of[c] for c in token.removesuffix(END))
            yield machine.feed(surface + b" " * token.endswith(END))
        yield machine.finish()

    def decode_tokens(self, ids: Iterable[int]) -> Iterator[str]:
        """The vocabulary's own spelling of the tokens, a blank between two, as a file without a decoder gives."""
        return self.decode_runs(itertools.batched(ids, 4096))

    def decode_runs(self, runs: Iterable[Iterable[int]]) -> Iterator[str]:
        """The same from ids in runs: one piece of text for each run, then what the machine still holds."""
        machine, blank, spelled = TextMachine(), b"", self.merges.spelled.__getitem__
        for run in runs:
            if data := b" ".join(map(spelled, run)):
                yield machine.feed(blank + data)
                blank = b" "
        yield machine.finish()

    def digests(self, text: str) -> tuple[int, str, str]:
        """(number of tokens, SHA-256 of the ids, SHA-256 of the text decoded from them), a run of pieces at a time."""
        n, all_ids, decoded = 0, hashlib.sha256(), hashlib.sha256()

        def emitted() -> Iterator[Iterable[int]]:
            nonlocal n
            blank = ""
            for run in self.pieces(text):
                counts, said, ids = zip(*run, strict=True)
                n += sum(counts)
                all_ids.update((blank + " ".join(said)).encode())
                blank = " "
                yield itertools.chain.from_iterable(ids)

        for part in self.decode_runs(emitted()):
            decoded.update(part.encode())
        return n, all_ids.hexdigest(), decoded.hexdigest()


def _stretches(text: str, at: int, end: int) -> Iterator[tuple[str, bool]]:
    """(stretch, whether its last word may go on in the next) over text[at:end]."""
    while at < end:
        far = at + 2 * STRETCH
        cut = _BLANK.search(text, at + STRETCH, min(far, end)) if at + STRETCH < end else None
        on = cut is None and far < end
        if on:
            cut = _INSIDE.search(text, far, end)
        stop = cut.start() if cut else end
        yield text[at:stop], on and stop < end
        at = stop


def _joining(stretches: Iterator[tuple[str, bool]]) -> Iterator[Iterator[str]]:
    """The stretches in runs, each of which goes on until a stretch that ends at a blank or with the text."""
    for first, on in stretches:
        yield _run(first, on, stretches)


def _run(text: str, on: bool, stretches: Iterator[tuple[str, bool]]) -> Iterator[str]:
    yield text
    while on:
        text, on = next(stretches)
        yield text


def _parts(texts: Iterator[str]) -> Iterator[tuple[str, bool]]:
    """(word or part of one, whether it ends there) of normalised stretches that join; what ends a word may be empty."""
    more = None
    for text in texts:
        at = 0
        if more:
            found = more.match(text)
            at = found.end() if found else 0
            ends = at < len(text)
            yield text[:at], ends
            if not ends:
                continue
            more = None
        for found in WORDS.finditer(text, at):
            word = found[0]
            if found.end() == len(text):
                more = _LETTERS if _LETTERS.fullmatch(word) else _OTHERS if _OTHERS.fullmatch(word) else None
            yield word, more is None
    if more:
        yield "", True


_CODECS: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """The worker's codec for a vocabulary file; its cache lives as long as the worker."""
    if path not in _CODECS:
        _CODECS[path] = Codec(load(path))
    return _CODECS[path]


def encode_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id, n_tokens, ids_sha256, decoded_sha256. path: the vocabulary file, on every machine."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(path)
        for batch in batches:
            found = [tool.digests(x.as_py()) for x in batch.column("text")]
            columns = [pa.array(list(c), t) for c, t in zip(zip(*found, strict=True), (pa.int64(), pa.string(), pa.string()), strict=True)] if found else [pa.array([], t) for t in (pa.int64(), pa.string(), pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *columns], names=["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = docs.select(named(id_col).alias("id"), blank_if_null(text_col).alias("text"))
    return rows.mapInArrow(run, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string").withColumnRenamed("id", id_col)


def encode_column(docs: DataFrame, path: str, text_col: str = "text", out: str = "token_ids") -> DataFrame:
    """docs with its texts' ids as an array column `out`, which replaces one of that name."""
    kept = [c for c in docs.columns if c != out]
    schema = T.StructType([*(docs.schema[c] for c in kept), T.StructField(out, T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(path)
        for batch in batches:
            ids = pa.array([tool.encode(x.as_py()) for x in batch.column(len(kept))], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], ids], names=schema.names)

    return docs.select(*map(named, kept), named(text_col)).toDF(*[f"c{i}" for i in range(len(kept) + 1)]).mapInArrow(run, schema)
