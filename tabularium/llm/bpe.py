"""Exact BPE encoding and decoding over a minimal acyclic transducer of frequent words.

The lexicon's words are the tokenizer's own whole words, and runs that a caller adds (``frequent_runs``; the queries add
none); it decides how fast a word is encoded, never how. Each word is compiled, with the ids that its exact merges
give, into a shared-suffix automaton (``compile_lexicon``). Arcs carry additive numbers whose sum along a word is the
word's place in the table of id sequences, so that equal suffixes stay one state though their outputs differ. The
compiled bytes (about 2 MB for 100,000 words; they never grow with the data) are broadcast; each Python worker maps them
from an unlinked file. A word that the transducer lacks is merged exactly.

Texts are cut into runs of white space and non-space; tokens never cross such cuts, so results of runs can be kept in a
memo of bounded size. Strings of added tokens are found first, as the tokenizers library does.

Defined results: a null text counts as empty and has no ids. Very long words are merged with a heap, and texts of any
length are encoded whole. A null doc_id stays null. Columns besides doc_id and text are ignored, whatever their names;
repeated rows are encoded alike; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import mmap
import re
import struct
import tempfile
import unicodedata
from array import array

import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import clean_text, worker_keep

#: White space as the tokenizers library's regular expressions know it (Unicode White_Space).
WHITE = r"\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
RUNS = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
#: Letters up to here have the same classes, cases and compositions in every Unicode version in use.
SIMPLE = re.compile(r"[^\x00-\u024f]")
#: What ``str.split`` takes for white space and the library does not.
ODD = re.compile(r"[\x1c-\x1f]")
#: Documents, at most about, whose most frequent words join the vocabulary's in the lexicon, and how many of them do.
SAMPLE, MOST_WORDS = 2000, 50_000
#: Ids are below 2**SHIFT.
SHIFT, MASK = 20, (1 << 20) - 1
BYTES = [bytes([b]) for b in range(256)]
#: First bytes of words whose walk through the transducer a worker keeps, and how many of them.
HEAD, MOST_HEADS = 4, 100_000
#: Entries of each generation of a worker's memos. When the young one is full it becomes the old one.
MEMO = 400_000


@functools.cache
def byte_chars() -> dict[int, str]:
    """Byte -> the printable character that stands for it in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Model:
    """A byte-level BPE tokenizer file: vocabulary, merge ranks, added tokens and the pattern that cuts words."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        # two ids side by side -> rank of their merge and the id that it gives, as one number each
        self.merges = {self.vocab[a] << SHIFT | self.vocab[b]: i << SHIFT | self.vocab[a + b] for i, (a, b) in enumerate(pairs)}
        self.suffix = model.get("end_of_word_suffix") or ""
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.added_pattern = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        steps = spec["pre_tokenizer"].get("pretokenizers", [spec["pre_tokenizer"]])
        own = [s["pattern"]["Regex"] for s in steps if s["type"] == "Split"]
        from public_tokenizers import PATTERN

        self.words = regex.compile(own[0] if own else PATTERN)
        self.lower = spec["normalizer"] is not None
        self.table = {b: c for b, c in byte_chars().items()}

    @functools.cached_property
    def _first(self) -> list[int]:
        return [self.vocab[self.table[b]] for b in range(256)]

    @functools.cached_property
    def _last(self) -> list[int]:
        return [self.vocab[self.table[b] + self.suffix] for b in range(256)]

    def merge(self, parts: list[int]) -> list[int]:
        """Apply merges by rank, leftmost first."""
        if len(parts) > 256:
            return self._merge_long(parts)
        get, none = self.merges.get, 1 << 60
        found = [get(a << SHIFT | b, none) for a, b in zip(parts, parts[1:])]
        while found:
            least = min(found)
            if least == none:
                break
            i = found.index(least)
            new = parts[i] = least & MASK
            del parts[i + 1]
            del found[i]
            if i:
                found[i - 1] = get(parts[i - 1] << SHIFT | new, none)
            if i < len(found):
                found[i] = get(new << SHIFT | parts[i + 1], none)
        return parts

    def _merge_long(self, parts: list[int]) -> list[int]:
        n = len(parts)
        after, before = [*range(1, n + 1)], [*range(-1, n - 1)]
        heap = [(r, i, parts[i], parts[i + 1]) for i in range(n - 1) if (r := self.merges.get(parts[i] << SHIFT | parts[i + 1])) is not None]
        heapq.heapify(heap)

        def offer(i: int) -> None:
            j = after[i]
            if j < n and (r := self.merges.get(parts[i] << SHIFT | parts[j])) is not None:
                heapq.heappush(heap, (r, i, parts[i], parts[j]))

        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if parts[i] != a or j >= n or parts[j] != b:
                continue
            parts[i], parts[j] = r & MASK, -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [p for p in parts if p >= 0]

    def word_ids(self, word: bytes) -> list[int]:
        parts = [*map(self._first.__getitem__, word)]
        if self.suffix:
            parts[-1] = self._last[word[-1]]
        return self.merge(parts)

    def id_bytes(self) -> dict[int, bytes]:
        back = {c: b for b, c in self.table.items()}
        found = {i: bytes(back[c] for c in p) for p, i in self.vocab.items()} if not self.suffix else {}
        return found | {i: c.encode() for c, i in self.added.items()}


def compile_lexicon(entries: dict[bytes, list[int]]) -> bytes:
    """Minimal acyclic transducer of ``entries`` (word -> ids): incremental construction over the sorted words."""
    registry: dict[tuple, int] = {}
    finals: list[bool] = []
    arcs: list[tuple[tuple[int, int], ...]] = []
    counts: list[int] = []  # words below each state

    def freeze(final: bool, out: dict[int, int]) -> int:
        key = (final, tuple(sorted(out.items())))
        if (state := registry.get(key)) is None:
            state = registry[key] = len(arcs)
            finals.append(final)
            arcs.append(key[1])
            counts.append(final + sum(counts[t] for _, t in key[1]))
        return state

    path: list[list] = [[False, {}]]  # states of the last word that may still change: final, arcs
    last = b""
    words = sorted(entries)
    for word in words:
        same = 0
        while same < min(len(word), len(last)) and word[same] == last[same]:
            same += 1
        for i in range(len(last), same, -1):
            done = path.pop()
            path[-1][1][last[i - 1]] = freeze(*done)
        path += [[False, {}] for _ in word[same:]]
        path[-1][0] = True
        last = word
    for i in range(len(last), 0, -1):
        done = path.pop()
        path[-1][1][last[i - 1]] = freeze(*done)
    root = freeze(*path[0])
    starts, labels, targets, adds = array("I", [0]), bytearray(), array("I"), array("I")
    for state, out in enumerate(arcs):
        seen = int(finals[state])
        for label, target in out:
            labels.append(label)
            targets.append(target)
            adds.append(seen)
            seen += counts[target]
        starts.append(len(labels))
    at, ids = array("I", [0]), array("I")
    for word in words:
        ids.extend(entries[word])
        at.append(len(ids))
    flags = bytes(finals)
    head = struct.pack("<6I", root, len(arcs), len(labels), len(words), len(ids), len(flags))
    body = b"".join(x.tobytes() for x in (starts, targets, adds, at, ids))
    return head + body + flags + bytes(labels)


class Lexicon:
    """A compiled transducer in mapped memory."""

    def __init__(self, compiled: bytes):
        with tempfile.TemporaryFile() as f:
            f.write(compiled)
            f.flush()
            self.map = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        self.root, states, arcs, words, ids, flags = struct.unpack_from("<6I", self.map)
        whole, at = memoryview(self.map), 24
        views = []
        for n in (states + 1, arcs, arcs, words + 1, ids):
            views.append(whole[at : at + 4 * n].cast("I"))
            at += 4 * n
        self.starts, self.targets, self.adds, self.at, self.ids = views
        self.flags, self.labels = at, at + flags
        self.words, self.states = words, states
        self.heads: dict[bytes, tuple[int, int] | None] = {}

    def _walk(self, word: bytes, state: int, place: int) -> tuple[int, int] | None:
        find, labels, starts = self.map.find, self.labels, self.starts
        for c in word:
            k = find(BYTES[c], labels + starts[state], labels + starts[state + 1]) - labels
            if k < 0:
                return None
            place += self.adds[k]
            state = self.targets[k]
        return state, place

    def get(self, word: bytes) -> bytes | None:
        """The word's ids as little-endian 32-bit integers, None if the lexicon lacks it."""
        head = word[:HEAD]
        if (at := self.heads.get(head, 0)) == 0:  # what the first bytes lead to is kept: words begin alike
            if len(self.heads) > MOST_HEADS:
                self.heads.clear()
            at = self.heads[head] = self._walk(head, self.root, 0)
        if at is None or (len(word) > HEAD and (at := self._walk(word[HEAD:], *at)) is None):
            return None
        state, place = at
        return bytes(self.ids[self.at[place] : self.at[place + 1]].cast("B")) if self.map[self.flags + state] else None


def vocabulary_words(model: Model) -> list[bytes]:
    """The vocabulary's entries that are whole words."""
    back = {c: b for b, c in model.table.items()}
    pieces = [p for p in model.vocab if p.endswith(model.suffix)]
    pieces = [p[: len(p) - len(model.suffix)] for p in pieces]
    return [bytes(back[c] for c in p) for p in pieces if p and all(c in back for c in p)]


def frequent_runs(docs: DataFrame, most_docs: int = SAMPLE, most: int = MOST_WORDS) -> list[str]:
    """The ``most`` runs of non-space met most often, twice at least, in about ``most_docs`` documents of (doc_id, text)."""
    share = min(1.0, most_docs / max(docs.count(), 1))
    sample = docs.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 20)) < F.lit(int((1 << 20) * share)))
    runs = sample.select(F.explode(F.split("text", r"\s+")).alias("run")).where(F.char_length("run").between(1, 63))
    top = runs.groupBy("run").count().where("count > 1").orderBy(F.desc("count"), "run").limit(most)
    return sorted(r[0] for r in top.collect())


def lexicon_of(path: str, runs: tuple[str, ...] = ()) -> bytes:
    """The vocabulary's words and those of ``runs``, with the ids of their exact merges."""
    model = Model(path)
    words = {*vocabulary_words(model)}
    if runs:
        encoder = Encoder(path, compile_lexicon({}))
        lead = "" if model.suffix else " "
        words |= {w.encode() for run in runs for w in encoder.cut(lead + run)}
    return compile_lexicon({w: model.word_ids(w) for w in words if w})


class Memo:
    """A bounded dictionary in two generations; what is used again moves to the young one."""

    def __init__(self, size: int):
        self.size, self.young, self.old = size, {}, {}

    def all(self, keys: list[str], make) -> list[bytes]:
        if len(self.young) > self.size:
            self.young, self.old = {}, self.young
        young = self.young
        found = [*map(young.get, keys)]
        if None in found:
            old = self.old
            for i in [i for i, value in enumerate(found) if value is None]:
                key = keys[i]
                if (value := young.get(key)) is None:
                    if (value := old.get(key)) is None:
                        value = make(key)
                    if len(key) < 64:
                        young[key] = value
                found[i] = value
        return found


class Encoder:
    """Text -> ids as packed little-endian 32-bit integers."""

    def __init__(self, path: str, compiled: bytes):
        self.model, self.lexicon, self.path = Model(path), Lexicon(compiled), path
        self.runs, self.words = Memo(MEMO), Memo(MEMO)
        # where a full stop or comma after letters is always a word of its own, no pattern need be tried for it
        self.marks = tuple(m for m in ".," if self.model.words.findall(f"ab{m}") == ["ab", m])

    @functools.cached_property
    def library(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def _word(self, word: str) -> bytes:
        raw = word.encode()
        if (ids := self.lexicon.get(raw)) is None:
            ids = array("I", self.model.word_ids(raw)).tobytes()
        return ids

    def cut(self, run: str) -> list[str]:
        """The words of a run, as the tokenizer normalises and cuts them."""
        lower = self.model.lower
        core = run[1:] if run[0] == " " and not lower else run
        if core.isalpha() and not SIMPLE.search(core):  # one word, whatever the pattern says of marks and digits
            if not lower:
                return [run]
            if (low := run.lower()).isalpha():
                return [low]
        if run.endswith(self.marks) and core[:-1].isalpha() and not SIMPLE.search(core):
            return [*self.cut(run[:-1]), run[-1]]
        if SIMPLE.search(run):  # other scripts: the library's own normaliser and word cuts, our merges
            library = self.library
            if library.normalizer:
                run = library.normalizer.normalize_str(run)
            return [bytes(self._back[c] for c in w).decode() for w, _ in library.pre_tokenizer.pre_tokenize_str(run)]
        if self.model.lower:
            run = unicodedata.normalize("NFC", run).lower()
        return self.model.words.findall(run)

    def _run(self, run: str) -> bytes:
        words = self.cut(run)
        if len(words) == 1:
            return self._word(run) if words[0] == run else self.words.all(words, self._word)[0]
        return b"".join(self.words.all(words, self._word))

    @functools.cached_property
    def _back(self) -> dict[str, int]:
        return {c: b for b, c in self.model.table.items()}

    def encode(self, text: str) -> bytes:
        if self.model.added_pattern and "<|" in text:
            return b"".join(struct.pack("<I", self.model.added[p]) if p in self.model.added else self._plain(p) for p in self.model.added_pattern.split(text))
        return self._plain(text)

    def _plain(self, text: str) -> bytes:
        if self.model.suffix and not ODD.search(text):  # such models drop white space
            runs = text.split()
        else:
            runs = RUNS.findall(text)
        return b"".join(self.runs.all(runs, self._run))


class Decoder:
    """Packed ids -> text; bytes that are no UTF-8 become U+FFFD."""

    def __init__(self, model: Model):
        self.bytes = model.id_bytes()

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.bytes.__getitem__, array("I", ids))).decode("utf-8", "replace")


@functools.lru_cache(maxsize=2)
def compiled_lexicon(path: str, runs: tuple[str, ...] = ()) -> bytes:
    return lexicon_of(path, runs)


def worker_encoder(path: str, compiled: bytes) -> Encoder:
    """One encoder, with its memo, for each Python worker."""
    return worker_keep((path, hashlib.md5(compiled).digest()), lambda: Encoder(path, compiled))


def encode(docs: DataFrame, tokenizer: str, decode: bool = True) -> DataFrame:
    """Add ids (array<int>) and decoded (string) to (doc_id, text)."""
    return _map(docs, tokenizer, "ids array<int>, decoded string", lambda ids, dec: (list(array("I", ids)), dec.decode(ids) if decode else None))


def _digest(ids: bytes, dec: Decoder):
    return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(dec.decode(ids).encode()).hexdigest()


def encode_digests(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each row of (doc_id, text)."""
    return _map(docs, tokenizer, "n_tokens long, ids_sha256 string, decoded_sha256 string", _digest)


def _map(docs: DataFrame, tokenizer: str, columns: str, row) -> DataFrame:
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import StructType

    added = StructType.fromDDL(columns)
    types = [to_arrow_type(f.dataType) for f in added]
    names = added.fieldNames()
    slim = docs.select("doc_id", clean_text().alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(compiled_lexicon(tokenizer))

    def run(batches):
        encoder = worker_encoder(tokenizer, shared.value)
        decoder = Decoder(encoder.model)
        for batch in batches:
            rows = [row(encoder.encode(t), decoder) for t in batch.column("text").to_pylist()]
            made = [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * len(types), types)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *made], names=["doc_id", *names])

    return slim.mapInArrow(run, StructType([slim.schema["doc_id"], *added]))
