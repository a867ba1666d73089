"""BPE encoding and decoding by batched merge rounds.

Reads tokenizer files whose model is BPE over byte symbols with a mark at the end of a word.
White space separates words and is dropped, so a text is encoded word by word: words seen before
come from a bounded memory, the new words of many documents are merged together. Their symbols lie
in one flat array; a round finds the pair of lowest rank of every word by binary search over the
sorted pair keys and merges it everywhere in that word. Words that have no known pair leave the
array.

Null text counts as empty and has no ids. Strings of added tokens in a text become their ids, as the
tokenizers library has it by default. A null or repeated id is passed through with its row.
"""
import json
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import blocks, id_and_text

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
#: Words kept in the memory of a Python worker before it starts afresh.
MEMORY_WORDS = 1_000_000
#: Characters of several documents that are encoded together.
GROUP_CHARS = 1 << 19

# Control characters that Python's split() takes for white space and the tokenizer does not.
_NOT_SPACE = "\x1c\x1d\x1e\x1f"
#: What the tokenizer drops between words: the only places where a long text may be cut.
_DROPPED = re.compile(r"[^\S\x1c-\x1f]")
_NO_RANK = np.iinfo(np.int64).max


def byte_letters():
    """The letter that stands for each byte: itself if printable, else the next free one."""
    kept = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1),
            *range(ord("®"), ord("ÿ") + 1)]
    letters = {b: chr(b) for b in kept}
    for b in range(256):
        letters.setdefault(b, chr(256 + len(letters) - len(kept)))
    return letters


class Encoder:
    """Encodes texts to packed little-endian unsigned 32-bit ids, and back."""

    def __init__(self, path, memory_words=MEMORY_WORDS):
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model = file["model"]
        vocab, mark = model["vocab"], model["end_of_word_suffix"]
        self.size = max(vocab.values()) + 1
        letters = byte_letters()
        self.first = np.array([vocab[letters[b]] for b in range(256)])
        self.last = np.array([vocab[letters[b] + mark] for b in range(256)])
        self.byte_of = {ord(letter): b for b, letter in letters.items()}
        pairs = [(a, b) for a, b in model["merges"]]
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in pairs])
        made = np.array([vocab[a + b] for a, b in pairs])
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order, made[order]

        self.added = {t["content"]: t["id"] for t in file["added_tokens"]}
        self.added_pattern = re.compile("|".join(map(re.escape, self.added)) or r"(?!)")
        names = {i: t for t, i in vocab.items()} | {i: t for t, i in self.added.items()}
        self.names = [names.get(i, "").encode() for i in range(max(names) + 1)]

        library = Tokenizer.from_file(path)
        self.normalizer, self.splitter = library.normalizer, library.pre_tokenizer
        # 0 outside words, 1 letter, 2 digit, 3 anything else: what the split pattern tells apart.
        kinds = [0 if chr(b).isspace() and chr(b) not in _NOT_SPACE else
                 1 if chr(b).isalpha() else 2 if chr(b).isdigit() else 3 for b in range(128)]
        self.kinds = np.array(kinds, np.int8)
        self.memory, self.memory_words = {}, memory_words

    def words_of(self, text):
        if any(c in text for c in _NOT_SPACE):
            spaces = "".join({c for c in text if c.isspace() and c not in _NOT_SPACE})
            return text.translate(dict.fromkeys(map(ord, spaces), " ")).split(" ")
        return text.split()

    def _ascii_pieces(self, words):
        """Bytes, length of each piece and its word, for ASCII words without an apostrophe."""
        data = np.frombuffer(" ".join(words).lower().encode(), np.uint8)
        kind = self.kinds[data]
        inside = kind > 0
        starts = inside & ((kind == 2) | np.append(True, kind[1:] != kind[:-1]))
        word = np.cumsum(~inside)[starts]
        lengths = np.bincount(np.cumsum(starts)[inside] - 1, minlength=len(word))
        return data[inside], lengths, word

    def _library_pieces(self, words):
        """The same for any words, with the library's own normaliser and splitter."""
        text = self.normalizer.normalize_str(" ".join(words))
        pieces = self.splitter.pre_tokenize_str(text)
        spaces = np.flatnonzero(np.frombuffer(text.encode("utf-32-le"), "<u4") == 32)
        word = np.searchsorted(spaces, np.array([at for _, (at, _) in pieces], np.int64))
        data = "".join([letters for letters, _ in pieces]).translate(self.byte_of).encode("latin-1")
        lengths = np.array([len(letters) for letters, _ in pieces], np.int64)
        return np.frombuffer(data, np.uint8), lengths, word

    def _learn(self, words):
        """Put the ids of new words into the memory."""
        plain, other = [], []
        for w in words:
            if self.added_pattern.search(w):
                self.memory[w] = self._with_added(w)
            elif w.isascii() and "'" not in w:
                plain.append(w)
            else:
                other.append(w)
        for group, pieces in ((plain, self._ascii_pieces), (other, self._library_pieces)):
            if group:
                self.memory.update(zip(group, self.merged(*pieces(group), len(group))))

    def _with_added(self, word):
        """Ids of a word that contains the string of an added token."""
        out, start = [], 0
        for found in self.added_pattern.finditer(word):
            out += [word[start:found.start()], self.added[found[0]]]
            start = found.end()
        out.append(word[start:])
        return b"".join(p.to_bytes(4, "little") if isinstance(p, int) else
                        self.merged(*self._library_pieces([p]), 1)[0] if p else b"" for p in out)

    def _rank(self, symbols, word, at):
        """Rank of the pair that starts at each of the positions, and what it merges to."""
        after = np.minimum(at + 1, len(symbols) - 1)
        key = symbols[at] * self.size + symbols[after]
        found = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        known = (self.keys[found] == key) & (word[at] == word[after]) & (after > at)
        return np.where(known, self.ranks[found], _NO_RANK), self.made[found]

    def merged(self, data, lengths, word, n_words):
        """Packed ids of each word. Pieces are merged apart; `word` says whose they are."""
        ends = np.cumsum(lengths)
        symbols = self.first[data]
        symbols[ends - 1] = self.last[data[ends - 1]]
        piece = np.repeat(np.arange(len(lengths)), lengths)
        done_symbols, done_pieces = [symbols[:0]], [piece[:0]]
        rank, made = self._rank(symbols, piece, np.arange(len(symbols)))
        while len(symbols):
            starts = np.flatnonzero(np.append(True, piece[1:] != piece[:-1]))
            spread = np.diff(np.append(starts, len(piece)))
            lowest = np.repeat(np.minimum.reduceat(rank, starts), spread)
            going = lowest != _NO_RANK
            done_symbols.append(symbols[~going])
            done_pieces.append(piece[~going])
            symbols, piece, rank, made, lowest = (
                x[going] for x in (symbols, piece, rank, made, lowest))
            index = np.flatnonzero(rank == lowest)
            if not len(index):
                break
            # Of overlapping occurrences (a a a) every second one is merged, from the left.
            new_run = np.append(True, np.diff(index) != 1)
            index = index[(index - index[new_run][np.cumsum(new_run) - 1]) % 2 == 0]
            symbols[index] = made[index]
            keep = np.ones(len(symbols), bool)
            keep[index + 1] = False
            symbols, piece, rank, made = (x[keep] for x in (symbols, piece, rank, made))
            here = (np.cumsum(keep) - 1)[index]
            changed = np.concatenate([here, here[here > 0] - 1])
            rank[changed], made[changed] = self._rank(symbols, piece, changed)
        symbols, piece = np.concatenate(done_symbols), np.concatenate(done_pieces)
        order = np.argsort(piece, kind="stable")
        packed = symbols[order].astype("<u4").tobytes()
        ends = np.cumsum(np.bincount(word[piece], minlength=n_words)) * 4
        return [packed[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]

    def encode_words(self, lists):
        """Packed ids of each list of words; the new words of all of them are merged together."""
        memory = self.memory
        distinct = set().union(*lists)
        new = distinct.difference(memory)
        if len(memory) + len(new) > self.memory_words:
            memory.clear()
            new = distinct
        if new:
            self._learn(list(new))
        # The large memory is asked once for each distinct word; the texts are put together from a small part of it.
        known = {w: memory[w] for w in distinct}
        return [b"".join(map(known.__getitem__, words)) for words in lists]

    def encode(self, texts):
        """Packed ids of each text, in order. Long texts are worked through in blocks."""
        group, chars = [], 0
        for text in texts:
            if len(text) > GROUP_CHARS:
                yield from self.encode_words(group)
                group, chars = [], 0
                yield b"".join(self.encode_words([self.words_of(b)])[0] for b in blocks(text, space=_DROPPED))
                continue
            group.append(self.words_of(text))
            chars += len(text)
            if chars > GROUP_CHARS:
                yield from self.encode_words(group)
                group, chars = [], 0
        yield from self.encode_words(group)

    def decode(self, ids):
        """Names of the ids with a space between, as a tokenizer without a decoder has it."""
        return b" ".join(map(self.names.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode()


@lru_cache(maxsize=2)
def encoder(path):
    """One encoder for all tasks of a Python worker."""
    return Encoder(path)


def encode(docs, path=WORD_BPE, id_col="doc_id", text_col="text"):
    """doc_id, ids (binary: little-endian unsigned 32-bit) and the decoded text of every row."""
    rows = id_and_text(docs, id_col, text_col)
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        own = encoder(path)
        for batch in batches:
            texts = (t.as_py() for t in batch.column("text"))
            ids, decoded = [], []
            for start, packed in enumerate(own.encode(texts)):
                ids.append(packed)
                decoded.append(own.decode(packed))
                if len(ids) == 256:
                    yield _slice(batch, start + 1, ids, decoded)
                    ids, decoded = [], []
            if ids:
                yield _slice(batch, batch.num_rows, ids, decoded)

    def _slice(batch, end, ids, decoded):
        doc_id = batch.column("doc_id").slice(end - len(ids), len(ids))
        return pa.RecordBatch.from_arrays(
            [doc_id, pa.array(ids, pa.binary()), pa.array(decoded, pa.string())],
            ["doc_id", "ids", "decoded"])

    return rows.mapInArrow(run, f"doc_id {id_type}, ids binary, decoded string")


def op8_bpe(spark, sf_dir):
    """Digests of ids and decoded text of every document."""
    coded = encode(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return coded.select(
        "doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
