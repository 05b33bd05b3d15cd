"""Plain Python versions to hold operators against."""

import hashlib
import re

SPACED = re.compile("[^\x20\x09-\x0d]+")
PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def spaced(text):
    return SPACED.findall(text or "")


def plain(text):
    return PLAIN.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def removed_words(docs, length=50):
    """(doc_id, n_words, n_removed, kept_sha256) of `(doc_id, text)` rows."""
    first = {}
    for doc, text in docs:
        words = spaced(text)
        for i in range(len(words) - length + 1):
            key = tuple(words[i : i + length])
            if doc is not None:
                first[key] = min(first.get(key, doc), doc)
    rows = []
    for doc, text in docs:
        words = spaced(text)
        gone = [False] * len(words)
        for i in range(len(words) - length + 1):
            if doc is not None and first[tuple(words[i : i + length])] < doc:
                gone[i : i + length] = [True] * length
        kept = " ".join(w for w, g in zip(words, gone, strict=True) if not g)
        rows.append((doc, len(words), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return rows
