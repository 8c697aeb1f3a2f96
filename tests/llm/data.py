"""Small hand-made documents with the hard cases, and plain versions of the operators."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0d]+")
SCHEMA = "doc_id long, text string, source string, kind int, id string, n_words string, _size string, row string"


def rows(seed: int = 5, n: int = 120) -> list[tuple]:
    """Documents with nulls, empty, long and repeated texts, shared lines, and columns whose names clash."""
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["The", "naïve", "中文", "a", "I'm", "x--y", "3.14"]
    shared = " ".join(rnd.choice(vocabulary) for _ in range(12))
    out = []
    for i in range(n):
        words = [rnd.choice(vocabulary) for _ in range(rnd.choice([1, 3, 19, 20, 60, 300]))]
        text = " ".join(words)
        if i % 3 == 0:
            text = f"{text}\n  {shared.upper() if i % 2 else shared}\t\n{text[:40]}"
        if i % 10 == 7 and out:
            text = out[rnd.randrange(len(out))][1]
        out.append((i, text, rnd.choice(["a", "a", "a", "b", "c", None, "é"]), i, "x", "y", "z", "r"))
    out += [(1000, None, "a", 1, None, None, None, None), (1001, "", "b", None, "x", "y", "z", "r"),
            (1002, " \t\n\x0b ", None, 1, "x", "y", "z", "r"), (None, shared + "\n" + shared, "a", 1, "x", "y", "z", "r"),
            (None, None, None, None, None, None, None, None), (1003, " ".join(vocabulary * 60), "big", 1, "x", "y", "z", "r"),
            (3, out[3][1], "a", 1, "x", "y", "z", "r"), (3, out[3][1], "a", 1, "x", "y", "z", "r"),
            (1004, "double  space \n\n end ", "a", 1, "x", "y", "z", "r"), (1005, "<|endoftext|> and more<|endoftext|>", "a", 1, "x", "y", "z", "r")]
    return out


def lower(t: str) -> str:
    return t.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def shingles(text: str | None, k: int) -> set:
    w = WORD.findall(lower(text or ""))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
