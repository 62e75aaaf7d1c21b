"""Token ids of texts with a public byte-level vocabulary; the files' places are parameters."""

from __future__ import annotations

import base64
import json
from collections.abc import Iterator

import numpy as np

_encoders: dict[str, object] = {}
_added: dict[str, list[str]] = {}


def encoder(path: str | None = None):
    """The encoder of the rank file at ``path``. Ids equal those of the JSON form of the same vocabulary for texts without its added tokens (tests compare them)."""
    import public_tokenizers
    import tiktoken

    path = path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    if path not in _encoders:
        with open(path, "rb") as file:
            ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, file)}
        _encoders[path] = tiktoken.Encoding("public", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _encoders[path]


def token_ids(texts: list[str | None], path: str | None = None) -> Iterator[np.ndarray]:
    own = encoder(path)
    for text in texts:
        yield np.array(own.encode_ordinary(text or ""), np.uint32)


def json_encoder(path: str | None = None):
    """The tokenizer of the JSON file at ``path`` with its own settings."""
    import public_tokenizers
    from tokenizers import Tokenizer

    path = path or public_tokenizers.path("byte_bpe_50k.json")
    if path not in _encoders:
        _encoders[path] = Tokenizer.from_file(path)
    return _encoders[path]


def added_literals(path: str | None = None) -> list[str]:
    """The literals of the tokens that the JSON file at ``path`` adds to its vocabulary."""
    import public_tokenizers

    path = path or public_tokenizers.path("byte_bpe_50k.json")
    if path not in _added:
        with open(path, encoding="utf-8") as file:
            _added[path] = [token["content"] for token in json.load(file).get("added_tokens") or []]
    return _added[path]


def json_token_ids(text: str | None, path: str | None = None, json_path: str | None = None) -> np.ndarray:
    """The ids that the JSON form gives: by itself for a text with the literal of an added token, else by the faster rank file."""
    if path and not json_path:
        raise ValueError("a rank file needs the JSON form of its vocabulary")
    if text and any(literal in text for literal in added_literals(json_path)):
        return np.array(json_encoder(json_path).encode(text, add_special_tokens=False).ids, np.uint32)
    return next(token_ids([text], path))
