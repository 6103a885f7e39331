"""Token ids of ``byte_bpe_50k.json`` as the tokenizers library gives them, for
mapInArrow workers.

Counts (``lengths``) come from the library itself. Packing needs the ids of every text,
within a budget that the library (3 MB a second here) does not meet; tiktoken runs the
same vocabulary several times faster. Both cut a text by one pattern, whose decisions
hang on the classes of neighbouring characters, and merge the pieces by the same ranks,
so they agree wherever their Unicode tables do. Texts made of long-settled Latin
characters and general punctuation go to tiktoken (a test compares the two on every such
character, on all pairs, and on longer runs of all classes); every other text goes to
the library. Special strings inside a text become their id in both, which is the
library's default.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import os
import re

import numpy as np

NAME = "byte_bpe_50k.json"
#: Characters whose classes (letter, number, space) are the same in all Unicode versions in use.
_OTHER = re.compile("[^\u0000-ɏ‐-‧‰-⁞€]")


class Encoder:
    """``path`` is the tokenizers JSON; the vocabulary of the fast path lies beside
    it as ``.tiktoken``."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.fast = None
        ranks_at = path.removesuffix(".json") + ".tiktoken"
        if os.path.exists(ranks_at):
            import public_tokenizers
            import tiktoken

            with open(ranks_at, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            special = {t.content: i for i, t in self.library.get_added_tokens_decoder().items()}
            self.fast = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def _slow(self, text: str) -> np.ndarray:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    def ids(self, text: str | None) -> np.ndarray:
        """Token ids of one whole text; null has none."""
        if not text:
            return np.empty(0, np.uint32)
        if self.fast is None or _OTHER.search(text):
            return self._slow(text)
        try:
            return self.fast.encode_to_numpy(text, allowed_special="all")
        except Exception:  # its regex engine gives up on huge runs of white space
            return self._slow(text)

    def lengths(self, texts) -> list[int]:
        """Token counts, by the library."""
        return [len(e.ids) for e in self.library.encode_batch_fast([t or "" for t in texts], add_special_tokens=False)]


@functools.cache
def encoder(path: str) -> Encoder:
    """One encoder a Python worker."""
    return Encoder(path)


@functools.cache
def version(path: str) -> str:
    """Digest of the tokenizer's file and the library's version: what cached counts belong to."""
    import tokenizers

    with open(path, "rb") as f:
        return hashlib.sha256(f.read() + tokenizers.__version__.encode()).hexdigest()


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(NAME)
