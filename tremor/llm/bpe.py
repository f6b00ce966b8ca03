"""BPE encoding of distinct words by traversing a trie of them, and decoding.

A word's encoding is the one sequence of tokens of which every neighbouring pair stays apart
under the merges. It ends in a token that depends on the prefix before that token alone, so each
node of a trie of words can be given the last token of its prefix's encoding: of the tokens that
end there, the one whose start has a last token that stays apart from it. A depth-first walk
does this once for every shared prefix, and a word's tokens are read off backwards.
"""

from __future__ import annotations

import hashlib
import json
import re
import sys
from array import array
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tremor.llm.common import slices, trimmed, utf8

_END = "</w>"
#: Texts that are their own normal form but for case, and whose letters no Unicode version disputes.
PLAIN = regex.compile("[!-~\u00a1-\u024f]+")
_NEVER = 1 << 60
# Keys, beside the bytes, of a token within a word and of one that ends it.
_OPEN, _ENDS = -1, -2


def byte_characters() -> dict[int, str]:
    """The printable character by which byte-level vocabularies show each byte: printable Latin-1
    characters stand for themselves, the other bytes for the characters from 256 on, in order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [byte for byte in range(256) if byte not in shown]
    return {**{b: chr(b) for b in shown}, **{b: chr(256 + k) for k, b in enumerate(hidden)}}


def plain_splitter(spec: dict) -> Callable[[str], list[str]] | None:
    """The pre-tokenizer for plain lower-case texts, if the file has the steps this stands for."""
    steps = [s["type"] for s in (spec["normalizer"] or {}).get("normalizers", [])]
    cuts = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
    if steps != ["NFC", "Replace", "Lowercase"] or [c["type"] for c in cuts] != ["Split", "ByteLevel"]:
        return None
    cut, to_bytes = cuts
    if cut["behavior"] != "Removed" or not cut["invert"] or to_bytes["use_regex"] or to_bytes["add_prefix_space"]:
        return None
    return regex.compile(cut["pattern"]["Regex"]).findall


class WordBpe:
    """Encodes and decodes as the tokenizer file says, which must be a BPE of words with ends.

    The library splits a text into words (normalizer and pre-tokenizer); everything after that
    is done here. ``memo_bytes`` bounds what is remembered of words met before.
    """

    def __init__(self, path: str, memo_bytes: int = 48 << 20):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        if sys.byteorder != "little" or array("I").itemsize != 4:
            raise ValueError("ids are written as the machine's own 32-bit numbers, which must be little-endian")
        if model["type"] != "BPE" or model["end_of_word_suffix"] != _END or spec["decoder"] or spec["post_processor"]:
            raise ValueError("a BPE with word ends and without a decoder is expected")
        if model["unk_token"] or model["continuing_subword_prefix"] or model["dropout"] or model["byte_fallback"]:
            raise ValueError("unknown tokens, prefixes, dropout and byte fallback are not supported")
        library = Tokenizer.from_file(path)
        self._normalize = library.normalizer.normalize_str
        self._split = library.pre_tokenizer.pre_tokenize_str
        self._plain_words = plain_splitter(spec)
        self._to_byte = {char: byte for byte, char in byte_characters().items()}
        self._added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(t["normalized"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError("added tokens are looked for in the text as it is")
        contents = sorted(self._added, key=len, reverse=True)
        self._special = re.compile("|".join(map(re.escape, contents))) if contents else None
        vocab = model["vocab"]
        self._pieces = [b""] * (max([*vocab.values(), *self._added.values()]) + 1)
        for token, number in (vocab | self._added).items():
            self._pieces[number] = token.encode()
        self._learn(vocab, model["merges"])
        self._memo_bytes = memo_bytes
        self.forget()

    def _learn(self, vocab: dict[str, int], merges: list) -> None:
        self._rank: dict[tuple[int, int], int] = {}
        self._parts: dict[int, tuple[int, int, int]] = {}
        for rank, merge in enumerate(merges):
            left, right = (vocab[p] for p in (merge if isinstance(merge, list) else merge.split(" ")))
            whole = vocab[self._pieces[left].decode() + self._pieces[right].decode()]
            if whole in self._parts or any(self._parts.get(p, (0, 0, -1))[2] >= rank for p in (left, right)):
                raise ValueError("merges must each make a new token of tokens made before")
            self._rank[left, right] = rank
            self._parts[whole] = (left, right, rank)
        #: Whether two tokens, packed into one number, stay apart when they meet.
        self._apart: dict[int, bool] = {}
        #: Trie of the tokens: children by byte, and the tokens that end at the node.
        self._tokens: dict = {}
        kept = set()
        for token, number in sorted(vocab.items(), key=lambda item: item[1]):
            parts = self._parts.get(number)
            if parts and not (parts[0] in kept and parts[1] in kept and self._meeting(parts[0], parts[1]) == parts[:2]):
                continue  # the merges never lead to this token
            kept.add(number)
            ends = token.endswith(_END) and token != _END
            node = self._tokens
            for symbol in token.removesuffix(_END) if ends else token:
                node = node.setdefault(self._to_byte[symbol], {})
            node[_ENDS if ends else _OPEN] = number

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """The pieces that hold the token's last (side 1) or first (0) symbol, smallest first,
        each with the rank of the merge that swallows it."""
        chain = [(token, _NEVER)]
        while parts := self._parts.get(chain[-1][0]):
            chain.append((parts[side], parts[2]))
        return chain[::-1]

    def _meeting(self, left: int, right: int) -> tuple[int, int] | None:
        """The first pieces of the two tokens that a merge joins across their border, if any."""
        ends, starts = self._edge(left, 1), self._edge(right, 0)
        i = j = 0
        while True:
            (a, a_until), (b, b_until) = ends[i], starts[j]
            across = self._rank.get((a, b), _NEVER)
            # Equal ranks are applied from left to right.
            if across < a_until and across <= b_until:
                return a, b
            if a_until == b_until == _NEVER:
                return None
            if a_until <= b_until:
                i += 1
            else:
                j += 1

    def forget(self) -> None:
        """Drops the memo; an idle worker need not keep it."""
        self._by_text: dict[bytes, bytes] = {}
        self._by_word: dict[bytes, bytes] = {}
        self._held = 0

    def _encode_words(self, words: Iterable[bytes]) -> None:
        """Adds the words' ids to the memo, walking their trie depth first.

        Sorted, the words are the leaves of their trie from left to right; what two neighbours
        share is the path to their last common node, whose states are kept on the stacks.
        """
        tokens, known = self._tokens, self._apart
        root = tokens.get
        last: list[int] = [0]  # of the prefix of each length on the path: its last token,
        start: list[int] = [0]  # where that begins,
        open_: list[list] = [[]]  # and what tokens are under way there, by their beginnings
        previous = b""
        for word in sorted(words):
            depth, most = 0, min(len(last), len(word)) - 1
            while depth < most and previous[depth] == word[depth]:
                depth += 1
            del last[depth + 1 :], start[depth + 1 :], open_[depth + 1 :]
            final = len(word) - 1
            while True:
                symbol = word[depth]
                reached = [(at, n) for at, t in open_[depth] if (n := t.get(symbol)) is not None]
                if (n := root(symbol)) is not None:
                    reached.append((depth, n))
                kind = _ENDS if depth == final else _OPEN
                for at, t in reached:
                    token = t.get(kind)
                    if token is None:
                        continue
                    if at:
                        pair = last[at] << 32 | token
                        fits = known.get(pair)
                        if fits is None:
                            fits = known[pair] = self._meeting(last[at], token) is None
                        if not fits:
                            continue
                    break
                else:
                    raise ValueError("the vocabulary lacks a symbol")
                if depth == final:
                    break
                last.append(token)
                start.append(at)
                open_.append(reached)
                depth += 1
            ids = [token]
            while at:
                ids.append(last[at])
                at = start[at]
            ids.reverse()
            self._by_word[word] = array("I", ids).tobytes()
            previous = word
            self._held += 130 + len(word) + 4 * len(ids)

    def _parts_of(self, text: bytes) -> list[bytes | int]:
        """Words, as bytes, and added tokens of a text without white space."""
        decoded = text.decode("utf-8")
        found: list[bytes | int] = []
        at = 0
        for match in self._special.finditer(decoded) if self._special and b"<" in text else ():
            found += self._words(decoded[at : match.start()])
            found.append(self._added[match[0]])
            at = match.end()
        return found + self._words(decoded[at:])

    def _words(self, text: str) -> list[bytes]:
        if self._plain_words and PLAIN.fullmatch(text):
            return [w.encode() for w in self._plain_words(text.lower())]
        split = self._split(self._normalize(text))
        return [bytes(map(self._to_byte.__getitem__, word)) for word, _ in split]

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each UTF-8 text as little-endian unsigned 32-bit numbers."""
        if self._held > self._memo_bytes:
            self.forget()
        if len(self._apart) > self._memo_bytes // 150:
            self._apart.clear()
        split = [text.split() for text in texts]
        fresh = [text for text in set().union(*split) if text not in self._by_text]
        parts = {text: self._parts_of(text) for text in fresh}
        words = {p for own in parts.values() for p in own if isinstance(p, bytes)}
        self._encode_words(word for word in words if word not in self._by_word)
        by_word = self._by_word
        for text, own in parts.items():
            self._by_text[text] = b"".join(
                [by_word[p] if isinstance(p, bytes) else p.to_bytes(4, "little") for p in own]
            )
            self._held += 160 + len(text)
        known = self._by_text.__getitem__
        return [b"".join(map(known, own)) for own in split]

    def decode(self, ids: bytes) -> bytes:
        """The UTF-8 text of the ids: a tokenizer without a decoder joins its tokens by spaces."""
        return b" ".join(map(self._pieces.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_loaded: dict[tuple[str, int], WordBpe] = {}


def word_bpe(path: str, memo_bytes: int = 48 << 20) -> WordBpe:
    """One encoder per process and file."""
    key = (path, memo_bytes)
    if key not in _loaded:
        _loaded[key] = WordBpe(path, memo_bytes)
    return _loaded[key]


def coded(
    docs: DataFrame,
    path: str,
    text: str = "text",
    doc_id: str = "doc_id",
    with_ids: bool = False,
    with_decoded: bool = False,
) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)`` for every row, and ``ids``, ``decoded`` on request.

    Texts are encoded whole and the ids decoded again, within the task that reads them: no
    shuffle. ``path`` must exist on every executor. A NULL text counts as empty, which has no
    ids and decodes to the empty text; NULL ids, repeated rows and an empty table are kept as
    they are, and other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = word_bpe(path)
        for batch in batches:
            texts = batch.column(1)
            for first, last in slices(texts, 2 << 20):
                ids = bpe.encode(texts[first:last].to_pylist())
                decoded = [bpe.decode(own) for own in ids]
                columns = [
                    batch.column(0)[first:last],
                    pa.array([len(own) // 4 for own in ids], pa.int64()),
                    pa.array([hashlib.sha256(own).hexdigest() for own in ids]),
                    pa.array([hashlib.sha256(own).hexdigest() for own in decoded]),
                ]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    columns.append(pa.array(ids, pa.binary()))
                    names.append("ids")
                if with_decoded:
                    columns.append(pa.array([d.decode() for d in decoded], pa.string()))
                    names.append("decoded")
                yield pa.RecordBatch.from_arrays(columns, names)
        bpe.forget()

    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), utf8(text).alias("text"))
    schema += ", ids binary" * with_ids + ", decoded string" * with_decoded
    return rows.mapInArrow(trimmed(run), schema)
