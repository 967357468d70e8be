"""Plain re-statements of the contracts, one text at a time, for the tests."""

import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower_ascii(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def digits(s):
    return re.sub("[^0-9]", "", s)


def luhn(number):
    total = 0
    for i, c in enumerate(reversed(number)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


PII = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.group().split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(digits(m.group())) <= 19 and luhn(digits(m.group()))),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m.group())) <= 15),
}
SECRETS = {
    "assign": (r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m.group(2)) >= 6),
    "access": (r"AKIA[A-Z0-9]+", lambda m: len(m.group()) >= 20),
    "hex": (r"[0-9a-f]+", lambda m: len(m.group()) >= 24),
}


def base_spans(text, rules):
    kinds = list(rules)
    found = [(m.start(), kinds.index(k), m.end()) for k, (rx, ok) in rules.items() for m in re.finditer(rx, text or "", re.ASCII) if ok(m)]
    return [f"{kinds[k]}:{s}:{e}" for s, k, e in sorted(found)]


def sha(spans):
    return hashlib.sha256(",".join(spans).encode()).hexdigest()


def shingles(text, n=5):
    words = WORD.findall(lower_ascii(text or ""))
    if not words:
        return set()
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if len(words) >= n else {tuple(words)}
