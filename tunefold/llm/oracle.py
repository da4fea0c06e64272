"""DuckDB SQL of the operators' queries where SQL can express the whole result.

None of the ten can be: each needs a tokenizer, a trained model, hashes or
iteration. ``tests/llm`` holds them against brute-force versions instead.
"""

from __future__ import annotations


def llm_oracle() -> dict[str, str]:
    return {}
