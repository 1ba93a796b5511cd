"""Words and prose for brute-force comparisons."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower_ascii(s):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in s)


def prose(seed, words, alphabet="abcdefgh"):
    r = random.Random(seed)
    return " ".join("".join(r.choice(alphabet) for _ in range(r.randint(2, 7))) for _ in range(words))
