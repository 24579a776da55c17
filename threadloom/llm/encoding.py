"""Ids of whole texts by the byte-level BPE vocabularies of the tokenizers library.

The ids of such a vocabulary are the ranks of its merges, so tiktoken gives the same ids from the same
file in a third of the time; that both agree on every code point is tested. Texts that may hold the
name of a special token, and files whose merges are not in order of their ids, go to the tokenizers
library itself.
"""

from __future__ import annotations

import json

import numpy as np

# Fixed value: the pattern by which such tokenizers cut texts into words.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def bytes_of_signs() -> dict[str, int]:
    """Bytes by the signs that stand for them in vocabularies: printable ones for themselves."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteEncoder:
    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.vocabulary = self.tokenizer.get_vocab_size()
        setting = json.loads(self.tokenizer.to_str())
        self.special = [token["content"] for token in setting["added_tokens"]]
        names, merges = setting["model"]["vocab"], setting["model"]["merges"]
        signs = bytes_of_signs()
        ranks = {bytes(signs[s] for s in name): number for name, number in names.items()
                 if name not in self.special}
        merged = [names["".join(m.split(" ") if isinstance(m, str) else m)] for m in merges]
        cut = setting["pre_tokenizer"]
        self.fast = None
        if (merged == sorted(merged) and setting["normalizer"] is None
                and cut["type"] == "ByteLevel" and not cut["add_prefix_space"]):
            self.fast = tiktoken.Encoding(
                "words", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> np.ndarray:
        if self.fast and not any(name in text for name in self.special):
            return np.array(self.fast.encode_ordinary(text), "<u4")
        found = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
        return np.array(found[0].ids, "<u4")


END = b"\x00"


def letters_encoder(tokenizer):
    """The same for words of small letters and a vocabulary that marks the ends of words.

    Gives a tiktoken encoding of words that are each followed by `END`, or None if the vocabulary is
    another one. The mark stands for the end in the names of tokens, so the last byte of a word meets it
    first, as the ids of single bytes with a mark come before those of merges.
    """
    import tiktoken

    setting = json.loads(tokenizer.to_str())["model"]
    suffix = setting.get("end_of_word_suffix")
    if setting["type"] != "BPE" or not suffix:
        return None
    names, signs, ranks = setting["vocab"], bytes_of_signs(), {}
    merged = [names["".join(m.split(" ") if isinstance(m, str) else m)] for m in setting["merges"]]
    for name, number in sorted(names.items(), key=lambda x: x[0].endswith(suffix)):
        core = name.removesuffix(suffix)
        if all(s in signs for s in core) and (core or name == suffix):
            ranks[bytes(signs[s] for s in core) + (END if core != name else b"")] = number
    singles = [ranks.get(bytes([b]) + end) for b in range(256) for end in (b"", END)]
    if None in singles or merged != sorted(merged) or max(singles) > min(merged):
        return None
    return tiktoken.Encoding("letters", pat_str=r"[^\x00]+\x00", mergeable_ranks=ranks,
                             special_tokens={})


_encoders: dict[str, ByteEncoder] = {}


def encoder_of(path: str) -> ByteEncoder:
    """The encoder of a worker process, kept from task to task."""
    if path not in _encoders:
        _encoders[path] = ByteEncoder(path)
    return _encoders[path]
