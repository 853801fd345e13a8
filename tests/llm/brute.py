"""Plain forms of what the operators compute."""

import re


def folded(text):
    """Words as bytes, ASCII case folded."""
    return [bytes(b + 32 if 65 <= b <= 90 else b for b in w) for w in re.findall(rb"[A-Za-z0-9\x80-\xff]+", (text or "").encode())]


def shingles(text, size=5):
    words = folded(text)
    return {tuple(words[i : i + size]) for i in range(max(len(words) - size + 1, 1))} if words else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a or b else 1.0
