"""Token ids of whole texts by a byte-level BPE vocabulary.

The vocabulary is a pair of files of one tokenizer: the ``tokenizers`` file,
whose ids are the ones wanted, and the same vocabulary as merge ranks, which
another library turns into the same ids several times faster. The two split
texts by the same pattern with different regular-expression engines, so the
fast one is used only where those cannot differ: on texts of ASCII, Latin and
common punctuation characters and of moderate length.

Control strings of the vocabulary (such as its end-of-text mark) inside a text
are ordinary text, unless ``control_ids`` asks for what a plain ``encode`` of the
``tokenizers`` file does: it turns them into their own ids.
"""

from __future__ import annotations

import base64
import json
import re

import numpy as np

from revmart.llm.workers import once

#: Characters whose classes (letter, digit, blank, other) every engine agrees on.
_PLAIN = re.compile("[^\t\n\r\x20-\x7e¡-ɏ‐-‧‰-⁞]")
_FAST_CHARS = 400_000


class ByteEncoder:
    def __init__(self, tokenizer_path: str, ranks_path: str | None, pattern: str | None, control_ids: bool = False) -> None:
        self._tokenizer_path, self._tokenizer = tokenizer_path, None
        self._control_ids, self._control = control_ids, ()
        if control_ids:
            with open(tokenizer_path, encoding="utf-8") as file:
                self._control = tuple(t["content"] for t in json.load(file).get("added_tokens") or [])
        self._fast = None
        if ranks_path and pattern:
            import tiktoken

            with open(ranks_path, "rb") as lines:
                ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
            self._fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    @property
    def _slow(self):
        """The tokenizer itself, loaded when a text first needs it."""
        if self._tokenizer is None:
            from tokenizers import Tokenizer

            self._tokenizer = Tokenizer.from_file(self._tokenizer_path)
            self._tokenizer.encode_special_tokens = not self._control_ids
        return self._tokenizer

    def _encode(self, text: str) -> list[int]:
        if self._fast is not None and len(text) <= _FAST_CHARS and not _PLAIN.search(text) and not any(c in text for c in self._control):
            return self._fast.encode_ordinary(text)
        return self._slow.encode(text, add_special_tokens=False).ids

    def ids(self, text: str) -> np.ndarray:
        return np.asarray(self._encode(text), dtype="<u4")

    def count(self, text: str) -> int:
        return len(self._encode(text))


def byte_encoder(tokenizer_path: str | None = None, ranks_path: str | None = None, control_ids: bool = False) -> ByteEncoder:
    """The encoder of a vocabulary, loaded once per worker; by default the
    installed public 50k byte-level BPE."""
    import public_tokenizers

    if tokenizer_path is None:
        tokenizer_path = public_tokenizers.path("byte_bpe_50k.json")
        ranks_path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return once(
        ("encoder", tokenizer_path, ranks_path, control_ids),
        lambda: ByteEncoder(tokenizer_path, ranks_path, public_tokenizers.PATTERN, control_ids),
    )
