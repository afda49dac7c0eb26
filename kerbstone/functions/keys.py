"""Surrogate keys: the same inputs give the same key in every batch and table.

As SQL text, for the reason given in the package's docstring.
"""

from __future__ import annotations

from kerbstone import rules


def key_text(name: str) -> str:
    """The text a surrogate key is the digest of, or the natural key itself.

    Two rows share this text exactly when they share the key, so grouping on it
    spares the digest for all but one row of each group.
    """
    if name in rules.NATURAL_KEYS:
        return rules.NATURAL_KEYS[name]
    parts = (
        f"coalesce(cast({part} as string), '{rules.UNKNOWN}')" for part in rules.SURROGATE_KEYS[name]
    )
    return f"concat_ws('{rules.KEY_SEPARATOR}', {', '.join(parts)})"


def digest(name: str, text: str) -> str:
    """Turn ``key_text`` into the stored key."""
    return text if name in rules.NATURAL_KEYS else f"md5({text})"


def key(name: str) -> str:
    return digest(name, key_text(name))


def is_key(name: str) -> bool:
    return name in rules.SURROGATE_KEYS or name in rules.NATURAL_KEYS
