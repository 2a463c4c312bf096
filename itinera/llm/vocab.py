"""Public tokenizer files inside tasks: loaded once a worker, never trained and never copied."""

from __future__ import annotations

import os
from functools import cache


def public_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@cache
def tokenizer(path: str, plain_specials: bool = False):
    """With ``plain_specials`` the strings of special tokens in a text are ordinary text. One object for each way, as
    workers are reused from query to query: nobody sets anything on it later."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks share the cores already
    from tokenizers import Tokenizer

    loaded = Tokenizer.from_file(path)
    loaded.no_truncation()
    loaded.no_padding()
    loaded.encode_special_tokens = plain_specials
    return loaded
