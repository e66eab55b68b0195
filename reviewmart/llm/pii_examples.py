"""A small labelled table: lines with personal data and secrets, and where they stand.

The lines are made from a seed, so the table is the same on every run.  Values have the
forms the rules know and forms they miss: spelled or spaced addresses, numbers without
``+``, cards in groups with dots, secrets behind a name.  Other lines hold numbers that
are none of these: versions, dates, sums, hashes of commits.
"""

from __future__ import annotations

import random
from collections.abc import Callable

Span = tuple[str, int, int]  # kind, start, end
LINES = 1500

LETTERS = "abcdefghijklmnopqrstuvwxyzéèñóüß"
HEX = "0123456789abcdef"
MIXED = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
NAMES = ("token", "api_key", "secret", "password", "auth", "access_key")


def _word(rng: random.Random, most: int = 11) -> str:
    word = "".join(rng.choice(LETTERS) for _ in range(rng.randint(1, most)))
    return rng.choice([word, word, word, word.capitalize(), word.upper()])


def _plain(rng: random.Random, most: int = 9) -> str:
    return "".join(rng.choice(LETTERS[:26]) for _ in range(rng.randint(1, most)))


def _digits(rng: random.Random, n: int) -> str:
    return "".join(rng.choice("0123456789") for _ in range(n))


def _card(rng: random.Random) -> str:
    """Sixteen digits that end on the check digit."""
    body = [int(x) for x in rng.choice("3456") + _digits(rng, 14)]
    total = sum(x * 2 - 9 * (x > 4) if i % 2 == 0 else x for i, x in enumerate(body))
    return "".join(map(str, body)) + str(-total % 10)


def _email(rng: random.Random) -> str:
    name = _plain(rng) + rng.choice(["", f".{_plain(rng)}", f".{_digits(rng, 2)}", _digits(rng, 1)])
    host, top = f"{_plain(rng)}{rng.choice(['', _digits(rng, 1)])}", rng.choice(["com", "example.com", "org"])
    at = rng.choice(["@", " [at] ", "[at]", "(at)", " (at) ", " @ "])
    dot = " . " if at == " @ " else rng.choice([".", ".", " [dot] ", "[dot]"]) if at != "@" else "."
    return name + at + host + dot + (top.replace(".", dot) if dot != "." else top)


def _ip(rng: random.Random) -> str:
    dot = rng.choice([".", ".", ".", " . ", "[.]"])
    return dot.join(str(rng.randint(1, 255)) for _ in range(4))


def _grouped_card(rng: random.Random) -> str:
    card = _card(rng)
    groups = [card[i : i + 4] for i in range(0, 16, 4)]
    return rng.choice([card, card, *(x.join(groups) for x in " -./")])


def _phone(rng: random.Random) -> str:
    area, mid, last = _digits(rng, 3), _digits(rng, 3), _digits(rng, 4)
    return rng.choice(
        [f"+{rng.randint(1, 99)} ({area}) {mid}-{last}", f"({area}) {mid}-{last}", f"({area}) {mid} {last}",
         f"{area}-{mid}-{last}", f"1 ({area}) {mid}-{last}", f"00{rng.randint(11, 99)} {area} {mid}{last}"]
    )


def _secret(rng: random.Random) -> str:
    alphabet, sizes = rng.choice([(HEX, (32, 40, 64)), (HEX, (40,)), (MIXED, (20, 24, 32, 40))])
    return "".join(rng.choice(alphabet) for _ in range(rng.choice(sizes)))


def _other(rng: random.Random) -> str:
    """Numbers and signs that are no personal data."""
    small = str(rng.randint(0, 9999))
    return rng.choice(
        [f"Version {rng.randint(1, 9)}.{rng.randint(0, 9)}", f"version {rng.randint(1, 9)}.",
         f"BY-NC {rng.randint(1, 9)}.0.", f"20{_digits(rng, 2)}-0{rng.randint(1, 9)}-1{rng.randint(0, 9)}",
         f"1{rng.randint(0, 9)}:{rng.randint(10, 59)}", f"${small}.{_digits(rng, 2)}", f"({small})",
         f"[{rng.randint(1, 99)}]", f"{small},{_digits(rng, 3)}", _digits(rng, rng.randint(1, 8)), f"{small}%",
         f"commit {''.join(rng.choice(HEX) for _ in range(40))}", f"@{_plain(rng)}", f"(at) {_plain(rng)}",
         f"{_plain(rng)} = {small}", f'{_plain(rng)} = "{_plain(rng)}"', f"{_plain(rng)}{_digits(rng, 2)}"]
    )


MAKERS: tuple[tuple[str, Callable[[random.Random], str]], ...] = (
    ("email", _email),
    ("ip", _ip),
    ("card", _grouped_card),
    ("phone", _phone),
    ("secret", _secret),
)


def _value(rng: random.Random) -> tuple[str, str, str, str]:
    """Kind ("" for none), what stands before the value, the value, what follows."""
    if rng.random() < 0.35:
        return "", "", _other(rng), ""
    kind, make = rng.choice(MAKERS)
    value = make(rng)
    if kind != "secret":
        return kind, *rng.choice([("", value, ""), ("", value, ""), ("(", value, ")"), ("", value, rng.choice(".,;!"))])
    quote = rng.choice(['"', '"', "'", ""])
    return kind, rng.choice(NAMES) + rng.choice([" = ", "=", ": "]) + quote, value, quote


def labelled(seed: int = 0, lines: int = LINES) -> list[tuple[str, list[Span]]]:
    """(line, spans) from the seed: one to three values among words of several scripts."""
    rng = random.Random(seed)
    made = []
    for _ in range(lines):
        mark = rng.choice(["", "", "", "", "", "!!", "***", "%%%", " |"])
        line, spans = "", []
        for _ in range(rng.choice([1, 1, 1, 2, 3])):
            for _ in range(rng.randint(0, 6)):
                line += _word(rng) + rng.choice(["", "", "", ",", "."]) + mark + " "
            kind, before, value, after = _value(rng)
            begin = len(line) + len(before)
            if kind:
                spans.append((kind, begin, begin + len(value)))
            line += before + value + after + mark + " "
        for _ in range(rng.randint(0, 4)):
            line += _word(rng) + mark + " "
        made.append((line[:-1], spans))
    return made
