"""Token ids of the public byte-level vocabularies, with a bounded per-worker memory of text chunks.

The vocabulary files stay where they are installed; only their path is passed around. A text is cut
at white space where the library's own pre-tokenizer always cuts, so chunks are encoded on their own
and give the ids of the whole text. Chunks that were not seen lately go to the library in batches.
"""

from __future__ import annotations

import base64
import itertools
import json
import os
import re
from functools import lru_cache

import numpy as np

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

CACHED_CHUNKS = 500_000
SLICE = 1 << 20
ID_TYPE = "<u2"


def path_of(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class ByteBpe:
    """Ids of ``byte_bpe_50k``: a word carries the one space before it.

    Texts are cut before single spaces and around single line ends. A text with other white space
    is cut only where one white-space character stands between two others. The rank file is the
    same vocabulary; a text with the special string goes to the tokenizers library whole.
    """

    SPECIAL = "<|endoftext|>"
    END_OF_LINE = 198
    CUT = re.compile(r"(?<=\S)(?=[ \n]\S)")

    def __init__(self, json_path: str, rank_path: str, pattern: str):
        import tiktoken

        with open(rank_path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self._fast = tiktoken.Encoding("byte_bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self._json_path = json_path
        self._after_space: dict[str, bytes] = {}
        self._first: dict[str, bytes] = {}
        self._line_end = np.array([self.END_OF_LINE], ID_TYPE).tobytes()

    def whole(self, text: str) -> bytes:
        return np.array(library(self._json_path).encode(text, add_special_tokens=False).ids, ID_TYPE).tobytes()

    def _learn(self, known: dict[str, bytes], chunks: set[str], lead: str) -> None:
        if len(known) + len(chunks) > CACHED_CHUNKS:
            known.clear()
        chunks = list(chunks)
        for at in range(0, len(chunks), 20_000):
            part = chunks[at : at + 20_000]
            ids = np.array(self._fast.encode_ordinary("\n".join([lead + c for c in part])), ID_TYPE)
            known.update(zip(part, split_at(ids, self.END_OF_LINE)))

    def encode(self, texts: list[str]) -> list[bytes]:
        cut, first, later = [], set(), set()
        for text in texts:
            if self.SPECIAL in text:
                cut.append(None)
                continue
            words = text.split()
            gaps = text.count(" ") + text.count("\n")
            if len(words) != gaps + 1 or len("".join(words)) + gaps != len(text):
                cut.append(self.CUT.split(text))
                continue
            lines = [line.split(" ") for line in text.split("\n")]
            cut.append(lines)
            first.update(line[0] for line in lines)
            for line in lines:
                later.update(line[1:])
        first -= self._first.keys()
        later -= self._after_space.keys()
        if len(self._first) + len(first) > CACHED_CHUNKS or len(self._after_space) + len(later) > CACHED_CHUNKS:
            self._first.clear(), self._after_space.clear()
            first = {line[0] for lines in cut if lines and isinstance(lines[0], list) for line in lines}
            later = {w for lines in cut if lines and isinstance(lines[0], list) for line in lines for w in line[1:]}
        self._learn(self._first, first, "")
        self._learn(self._after_space, later, " ")
        out = []
        for text, parts in zip(texts, cut):
            if parts is None:
                out.append(self.whole(text))
            elif parts and isinstance(parts[0], list):
                get = self._after_space.__getitem__
                out.append(self._line_end.join(
                    self._first[line[0]] + b"".join(map(get, itertools.islice(line, 1, None))) for line in parts
                ))
            else:
                out.append(b"".join(np.array(self._fast.encode_ordinary(p), ID_TYPE).tobytes() for p in parts))
        return out


class WordBpe:
    """Ids of ``word_bpe_49k``: lower case, white space dropped, a mark at each word's end.

    Chunks between spaces and line ends never influence each other. In a chunk of Latin letters
    the normal form is the text itself and each word is merged by rank, with a space as its end
    mark; every token of the vocabulary is the merge of itself, so merging by the rank of the result
    equals merging by the listed pairs. Other chunks go to the tokenizers library.
    """

    WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
    OTHER = re.compile("[^\x00-ɏ]")
    SPECIAL = "<|"

    def __init__(self, json_path: str):
        import regex
        import tiktoken

        with open(json_path, encoding="utf-8") as file:
            vocabulary = json.load(file)["model"]["vocab"]
        bytes_of = {c: b for b, c in byte_letters().items()}
        ranks = {}
        for token, rank in vocabulary.items():
            ended = token.endswith("</w>") and token != "</w>"
            body = token[:-4] if ended else token
            if all(c in bytes_of for c in body):
                raw = bytes(bytes_of[c] for c in body)
                if b" " not in raw:
                    ranks[raw + b" " * ended] = rank
        ranks[b" "] = len(vocabulary)
        self._break = ranks[b"\n"]
        self._fast = tiktoken.Encoding("word_bpe", pat_str=r"\S+ |\n", mergeable_ranks=ranks, special_tokens={})
        self._json_path = json_path
        self._words = regex.compile(self.WORDS)
        self._known: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        return np.array(library(self._json_path).encode(text, add_special_tokens=False).ids, ID_TYPE).tobytes()

    def _learn(self, chunks: list[str]) -> None:
        plain = []
        for chunk in chunks:
            if self.OTHER.search(chunk) or self.SPECIAL in chunk:
                self._known[chunk] = self.whole(chunk)
            else:
                plain.append(chunk)
        for at in range(0, len(plain), 20_000):
            part = plain[at : at + 20_000]
            find = self._words.findall
            text = "\n".join(["".join([w + " " for w in find(c.lower())]) for c in part])
            ids = np.array(self._fast.encode_ordinary(text), ID_TYPE)
            self._known.update(zip(part, split_at(ids, self._break)))

    def encode(self, texts: list[str]) -> list[bytes]:
        cut = [text.replace("\n", " ").split(" ") for text in texts]
        new = set(itertools.chain.from_iterable(cut)) - self._known.keys()
        if len(self._known) + len(new) > CACHED_CHUNKS:
            self._known.clear()
            new = set(itertools.chain.from_iterable(cut))
        self._learn(list(new))
        get = self._known.__getitem__
        return [b"".join(map(get, parts)) for parts in cut]


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def split_at(ids: np.ndarray, mark: int) -> list[bytes]:
    """The byte strings between the ids equal to ``mark``."""
    ends = np.append(np.flatnonzero(ids == mark), len(ids))
    starts = np.append(0, ends[:-1] + 1)
    raw = ids.tobytes()
    return [raw[2 * a : 2 * b] for a, b in zip(starts.tolist(), ends.tolist())]


@lru_cache(maxsize=2)
def library(json_path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(json_path)


@lru_cache(maxsize=1)
def byte_bpe(json_path: str) -> ByteBpe:
    import public_tokenizers

    return ByteBpe(json_path, json_path.removesuffix(".json") + ".tiktoken", public_tokenizers.PATTERN)


@lru_cache(maxsize=1)
def word_bpe(json_path: str) -> WordBpe:
    return WordBpe(json_path)
