"""Public tokenizers inside tasks.

A byte-level BPE file is read by its own library; where its ids grow in the order of its merges, the
same merges run by the faster public library for such vocabularies, and the tests hold both against
each other. Texts with a special string, and other kinds of files, go through the file's own library.
"""

from __future__ import annotations

import hashlib
import json
from pathlib import Path


def tokenizer_version(path: str) -> str:
    """Digest of the tokenizer's file and of the library that reads it."""
    if path.endswith(".json"):
        import tokenizers as library
    else:
        import sentencepiece as library
    return hashlib.sha256(Path(path).read_bytes() + library.__version__.encode()).hexdigest()


#: The pattern by which byte-level pre-tokenizers cut (a fixed value of the public vocabulary).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_of() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves and the others, in order, from code point 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def _merger(spec: dict):
    """The same merges by the faster of the public libraries; None unless ids grow in the order of the merges, as that library needs."""
    vocab, merges = spec["model"]["vocab"], [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
    added = {t["content"] for t in spec.get("added_tokens", [])}
    ids = [vocab.get("".join(m), -1) for m in merges]
    if len(vocab.keys() - added) != 256 + len(merges) or ids != sorted(ids) or min(ids, default=256) < 256:
        return None
    import tiktoken

    byte = _byte_of()
    ranks = {bytes(byte[c] for c in token): k for token, k in vocab.items() if token not in added}
    return tiktoken.Encoding("byte_level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


class Encoder:
    """ids of whole texts, without added special tokens, truncation or padding."""

    def __init__(self, path: str) -> None:
        self.merge, self.special = None, []
        if path.endswith(".json"):
            from tokenizers import Tokenizer

            spec = json.loads(Path(path).read_text())
            before, self.special = spec.get("pre_tokenizer") or {}, [t["content"] for t in spec.get("added_tokens", [])]
            tokenizer = Tokenizer.from_file(path)
            tokenizer.no_truncation()
            tokenizer.no_padding()
            self.whole = lambda text: tokenizer.encode(text, add_special_tokens=False).ids
            if spec.get("normalizer") is None and spec["model"]["type"] == "BPE" and not spec["model"].get("dropout") and before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space"):
                self.merge = _merger(spec)
        else:
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.whole = lambda text: model.encode(text, num_threads=1)

    def ids(self, text: str) -> list[int]:
        if self.merge is None or any(s in text for s in self.special):
            return self.whole(text)
        return self.merge(text)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One for each worker process."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
