"""The small labelled table that the tagger of personal data is trained on, made from a seed and frames."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

# Syllables of filler words, words that announce something, and marks that follow a word.
SYLLABLES = "an ar be ch de en er es ge in io la le li ment ne on or ou que ra re se th ti tion un ver".split()
CUES = {
    "email": ["mail", "email", "contact", "e-mail:", "write", "to"],
    "ip": ["from", "host", "address", "ip", "server", "at"],
    "card": ["card", "card:", "visa", "number", "paid", "pan"],
    "phone": ["phone", "tel", "tel:", "call", "mobile", "on"],
    "secret": ["token =", "TOKEN =", "key =", "api_key =", "secret =", "password =", "token:"],
}
# What announces a secret of letters, and words that follow such words in plain speech.
LETTER_CUES = ["password =", "password:", "Password:", "passwd =", "passphrase:", "secret =", "secret:", "token =", "pwd:", "key ="]
PLAIN = "is was for of to in and must can will has that which the a".split()
MARKS = ["", "", "", "", ".", ",", "!!", "###", "***", "$$$", "%%%", "&&&", ";"]


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        n = int(c) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _word(r: random.Random) -> str:
    return "".join(r.choice(SYLLABLES) for _ in range(r.randint(1, 4)))


def _digits(r: random.Random, n: int) -> str:
    return "".join(r.choice("0123456789") for _ in range(n))


def _card(r: random.Random, good: bool) -> str:
    while True:
        body = r.choice("3456") + _digits(r, r.choice([12, 14, 14, 14, 15]))
        digits = next(body + c for c in "0123456789" if luhn(body + c) == good)
        if luhn(digits) == good:
            return digits


def _hex(r: random.Random, n: int) -> str:
    return "".join(r.choice("0123456789abcdef") for _ in range(n))


def _ip(r: random.Random, top: int = 255) -> str:
    return ".".join(str(r.randint(0, top)) for _ in range(4))


def _example(r: random.Random, kind: str) -> list[str]:
    """The words of one thing to find."""
    a, b, c = (str(r.randint(200, 999)) for _ in range(3))
    last = _digits(r, 4)
    if kind == "email":
        return [f"{_word(r)}{r.choice(['.', '_', '', '-'])}{_digits(r, r.randint(0, 3))}@{r.choice(['mail', _word(r)])}{_digits(r, r.randint(0, 2))}.{r.choice(['example.com', 'com', 'org', 'net', 'co.uk'])}"]
    if kind == "ip":
        return [r.choice([_ip(r), _ip(r), f"{_ip(r)}:{r.randint(80, 65000)}", ":".join(_hex(r, 4) for _ in range(8))])]
    if kind == "card":
        digits = _card(r, True)
        return [digits] if r.random() < 0.6 else [".".join(digits[k : k + 4] for k in range(0, len(digits), 4))] if r.random() < 0.3 else [digits[k : k + 4] for k in range(0, len(digits), 4)]
    if kind == "phone":
        return r.choice([["+1", f"({a})", f"{b}-{last}"], ["+1", f"({a})", f"{b}-{last}"], [f"({a})", f"{b}-{last}"], [f"{a}-{b}-{last}"], [f"+{r.randint(30, 99)}", a, b, c], [f"+{r.randint(30, 99)}{a}{b}{c}"]])
    text = _hex(r, r.choice([24, 32, 40, 40, 40, 64]))
    text = text.upper() if r.random() < 0.3 else text
    return [f'"{text}"' if r.random() < 0.7 else text]


def _letters(r: random.Random) -> str:
    """A secret of letters alone."""
    a, b = _word(r), _word(r)
    text = r.choice([a, a + b, a.capitalize() + b.capitalize(), (a + b).upper(), f"{a}-{b}", f"{a}_{b}", a + b + _word(r)])
    return f'"{text}"' if r.random() < 0.4 else text


def _filler(r: random.Random) -> str:
    """A word that is nothing, of any length and shape: what a secret of letters looks like tells nothing by itself."""
    kind = r.random()
    if kind < 0.4:
        return _word(r)
    if kind < 0.55:
        return r.choice([str.lower, str.lower, str.capitalize, str.upper])(r.choice(PLAIN))
    if kind < 0.75:
        return "".join(r.choice(SYLLABLES) for _ in range(r.randint(3, 9)))
    if kind < 0.85:
        return _letters(r).strip('"')
    return r.choice([lambda: _word(r).capitalize(), lambda: _word(r).upper(), lambda: r.choice("aeiAEIBCDXYZ"), lambda: r.choice([str.lower, str.upper])(_word(r).replace("e", r.choice("éèüñó"))), lambda: r.choice(["-", "|", "=", ":", "***", "###", "$$$", "—", "&", "//", "日本", "{", "}"]), lambda: f"<{_word(r)}>", lambda: f"{_word(r)}'{r.choice('sdt')}"])()


def _speech(r: random.Random) -> list[str]:
    """Words that announce something, in plain speech, and signs that announce nothing."""
    cue = r.choice(LETTER_CUES).split()[0].strip(":").lower()
    return r.choice([lambda: [cue, r.choice(PLAIN), _word(r)], lambda: [f"{_word(r)}:", _word(r)], lambda: [_word(r), "=", _word(r)], lambda: [cue, _word(r)], lambda: [cue + r.choice(".,"), _word(r)], lambda: [f'"{_word(r)}"', _word(r)]])()


def _nothing(r: random.Random) -> list[str]:
    """Words with digits or an at sign that are none of it."""
    n = r.randint(0, 5000)
    return r.choice(
        [
            lambda: [str(r.randint(1900, 2099))],
            lambda: [str(n)],
            lambda: [f"{n}.{_digits(r, 2)}"],
            lambda: [f"{r.randint(1, 9)}.{r.randint(0, 9)}"],
            lambda: [f"v{r.randint(0, 9)}.{r.randint(0, 20)}.{r.randint(0, 9)}"],
            lambda: [f"{r.randint(0, 9)}.{r.randint(0, 20)}.{r.randint(0, 9)}"],
            lambda: [f"20{_digits(r, 2)}-0{r.randint(1, 9)}-1{r.randint(0, 9)}"],
            lambda: [f"{r.randint(0, 23)}:{_digits(r, 2)}"],
            lambda: [f"{r.randint(1, 99)}%"],
            lambda: [f"{r.randint(1, 31)}th", str(r.randint(1900, 2099))],
            lambda: [f"${n},{_digits(r, 3)}"],
            lambda: [f"@{_word(r)}"],
            lambda: [f"{_word(r)}@{_word(r)}"],
            lambda: [f"#{n}"],
            lambda: [f"{_word(r)}{r.randint(1, 99)}"],
            lambda: [f"{r.randint(1, 99)}", f"{r.randint(1, 99)}", f"{r.randint(1, 99)}"],
            lambda: [f"p{r.randint(1, 300)}-{r.randint(301, 600)}"],
            lambda: [f"({r.randint(1, 99)})"],
            lambda: [_card(r, False)],
            lambda: [_digits(r, r.randint(5, 11))],
            lambda: [_digits(r, r.randint(20, 30))],
            lambda: [".".join(str(r.randint(256, 999)) for _ in range(4))],
            lambda: [f"{r.randint(100, 999)}-{r.randint(10, 99)}"],
            lambda: [f"+{r.randint(1, 99)}"],
            lambda: [f"{_hex(r, 6)}{r.randint(0, 9)}"],
        ]
    )()


def examples(count: int = 1500, seed: int = 11) -> list[tuple[int, int, str, str]]:
    """(sentence, position, word, tag) of so many sentences; tags are O, B-kind and I-kind."""
    r = random.Random(seed)
    rows = []
    for n in range(count):
        words: list[tuple[str, str]] = []
        for _ in range(r.randint(1, 3)):
            words += [(_filler(r) + r.choice(MARKS), "O") for _ in range(r.randint(1, 8))]
            kind = r.choice([*CUES, "letters", "letters", None, None, None, None, "speech"])
            if kind in (None, "speech"):
                mark = r.choice(MARKS)
                found = [(w, "O") for w in (_nothing(r) if kind is None else _speech(r))]
            elif kind == "letters":
                mark = r.choice(MARKS)
                words += [(w, "O") for w in r.choice(LETTER_CUES).split()]
                found = [(_letters(r), "B-secret")]
            else:
                if kind == "secret" or r.random() < 0.3:
                    words += [(w, "O") for w in r.choice(CUES[kind]).split()]
                each, mark = r.choice(["", "", "", "###", "&&&", "%%%", "!!"]), r.choice(MARKS)
                things = _example(r, kind)
                if kind == "card" and r.random() < 0.1:
                    things *= 2
                    tags = ["B-card"] * len(things) if len(things) == 2 else ["B-card", *["I-card"] * (len(things) // 2 - 1)] * 2
                else:
                    tags = [f"B-{kind}", *[f"I-{kind}"] * (len(things) - 1)]
                found = [(w + each * (k < len(things) - 1), t) for k, (w, t) in enumerate(zip(things, tags, strict=True))]
            words += found[:-1] + [(found[-1][0] + mark, found[-1][1])]
        words += [(_filler(r), "O") for _ in range(r.randint(0, 3))]
        rows += [(n, k, w, t) for k, (w, t) in enumerate(words)]
    return rows


def labelled(spark: SparkSession, count: int = 1500, seed: int = 11) -> DataFrame:
    """The same as a table."""
    return spark.createDataFrame(examples(count, seed), "sentence int, position int, word string, tag string")
