"""Personal data: patterns for e-mail, IP, card and phone, and a linear-chain CRF for secrets.

The CRF labels tokens as outside, beginning or inside of a secret from their shapes and their neighbours'
words. It is trained on the driver from a labelled table made from sentence patterns: keys, passwords,
grouped keys, UUIDs, names and addresses. All tokens of a text are scored. Where the scores rule out every
label but outside, the chain falls apart, and Viterbi decodes the runs between, many at a time, with the
result it has on the whole chain.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadline.llm.frames import each_text, texts

KINDS = ("email", "ip", "card", "phone", "secret")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def _emails(text: str):
    at, taken = text.find("@"), 0
    while at >= 0:
        begin = at
        while begin > taken and _LOCAL.match(text, begin - 1):
            begin -= 1
        domain = _DOMAIN.match(text, at + 1) if begin < at else None
        if domain:
            taken = domain.end()
            yield begin, taken
        at = text.find("@", max(at + 1, taken))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``start, kind, end`` of the patterns' matches, leftmost and not overlapping within a kind."""
    found = [(a, 0, b) for a, b in _emails(text)]
    if _DIGITS.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
                found.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and _luhn(digits):
                found.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= len(_DIGITS.findall(m.group())) <= 15:
                    found.append((m.start(), 3, m.end()))
    found.sort()
    return found


# the CRF

#: A word, a sign or an underscore, with one white space before it where there is one.
_TOKEN = re.compile(r"\s?(?:[^\W_]+|[^\w\s]|_)")
#: Tokens known to a worker at once, the characters they may have together, tokens scored at once, and
#: characters of the texts decoded at once.
_KNOWN, _KNOWN_CHARS, _SCORED, _TOGETHER = 300_000, 16_000_000, 1 << 17, 1 << 20
#: Runs that are decoded one by one once no more are left.
_FEW = 24
#: Places of the neighbours a token is judged with.
_PLACES = (-3, -2, -1, 1, 2)
#: How far back a token may stand once more.
_SAME = (1, 2)

_GIVEN = frozenset(
    "james john robert michael william david richard joseph thomas charles daniel matthew anthony mark paul steven andrew kevin brian george "
    "edward peter henry frank alice mary patricia jennifer linda elizabeth barbara susan jessica sarah karen nancy lisa margaret sandra emily "
    "emma olivia laura anna maria sofia julia helen ruth diane grace hannah jose juan carlos luis miguel pedro pablo diego javier manuel carmen "
    "lucia elena isabel rosa ana marta pilar jean pierre jacques michel philippe nicolas antoine claire camille sophie chloe julie isabelle "
    "hans klaus peter stefan jürgen wolfgang thomas andreas lukas felix max heike sabine ursula petra monika ingrid anja lena katrin marco "
    "luca giulia francesca giovanni ahmed mohammed ali fatima omar yusuf wei ming li mei hiroshi yuki priya raj amit ivan olga dmitri natasha".split()
)
_STREET = frozenset(
    "street st avenue ave road rd lane ln drive dr boulevard blvd court ct way place square terrace crescent close highway parkway strasse "
    "straße weg platz allee gasse rue calle avenida plaza via".split()
)


def _shape(token: str) -> str:
    return re.sub(r"(.)\1+", r"\1", "".join("d" if c.isdigit() else "X" if c.isupper() else "x" if c.isalpha() else c for c in token))[:12]


def _kind(low: str) -> str:
    return "given" if low in _GIVEN else "street" if low in _STREET or low.endswith(("strasse", "straße")) else ""


#: The class of each ASCII sign, as ``_shape`` has them, and whether it is a digit.
_CLASSES = {c: "d" if chr(c).isdigit() else "X" if chr(c).isupper() else "x" if chr(c).isalpha() else chr(c) for c in range(128)}
_DIGIT_OR_NOT = {c: "d" if chr(c).isdigit() else "c" for c in range(128)}
_REPEATED = re.compile(r"(.)\1+")


def _looks(token: str) -> tuple:
    """What features but those of the word itself rest on; few tokens look different."""
    word = token.lstrip()
    low = word.lower()
    gap = "glued" if word == token else "line" if token[0] in "\n\r" else "space"
    hexed = not low.strip("0123456789abcdef")
    if word.isalpha() and (word.islower() or word[0].isupper() and (len(word) == 1 or word[1:].islower())):  # nearly all words
        letters, turns, shape = len(word), 0, "x" if word.islower() else "Xx"[: len(word)]
    elif word.isascii():
        classes = word.translate(_CLASSES)
        letters, changes = classes.count("x") + classes.count("X"), word.translate(_DIGIT_OR_NOT)
        turns, shape = changes.count("dc") + changes.count("cd"), _REPEATED.sub(r"\1", classes)[:6]
    else:
        letters = sum(c.isalpha() for c in word)
        turns = sum(a.isdigit() != b.isdigit() for a, b in zip(word, word[1:], strict=False))
        shape = _shape(word)[:6]
    sign = word if len(word) == 1 and not word.isalnum() else ""
    return gap, min(len(word), 40) // 4, hexed and letters > 0, 0 < letters < len(word), min(turns, 8) // 2, letters == 0, shape, _kind(low), sign


def _own(looks: tuple) -> list[str]:
    """Features of a token by its looks."""
    gap, size, hexed, mixed, turns, digits, shape, kind, _ = looks
    return [
        "bias", f"gap={gap}", f"len={size}", f"hex={hexed}", f"mixed={mixed}", f"turns={turns}", f"digits={digits}", f"shape={shape}", f"shape={shape} {gap}",
        f"kind={kind}", f"kind={kind} {shape}",
    ]


def _near(place: int, looks: tuple) -> list[str]:
    """Features the looks of a token give to the one that has it at ``place``."""
    gap, size, _, _, _, _, shape, kind, sign = looks
    return [f"{place}shape={shape} {min(size, 3)}", f"{place}kind={kind}", *([f"glued={gap == 'glued'} {sign}"] if place == 1 else [])]


def _features(before: list[str], token: str, after: list[str]) -> list[str]:
    """Features of one token between its neighbours, nearest last in ``before`` and first in ``after``."""
    out = [*_own(_looks(token)), f"0={token.strip().lower()}"]
    for place in _PLACES:
        side, k = (before, place) if place < 0 else (after, place - 1)
        if -len(side) <= k < len(side):
            out += [*_near(place, _looks(side[k])), f"{place}={side[k].strip().lower()}"]
        else:
            out.append(f"{place}=")
    return out + [f"same {k}" for k in _SAME if len(before) >= k and before[-k] == token]


def _sentences(rng: random.Random):
    """Endless sentences as parts ``text, is it a secret``, one kind of secret or look-alike after the other."""
    digits, small = "0123456789", "abcdefghijklmnopqrstuvwxyz"
    alnum = small + small.upper() + digits
    common = "the of and data server when please use this with for report les und der que la von is was on in to by new from".split()
    syllables = "ba cor den el fa gri ho in jo ka lor mi nu or pe qui ras so tan ul ve wis xa yor zem ber ston man ley ard ez er son ier au".split()
    given = sorted(_GIVEN)

    def of(letters, n):
        return "".join(rng.choice(letters) for _ in range(n))

    def made(low=2, high=3):
        return "".join(rng.choice(syllables) for _ in range(rng.randint(low, high)))

    def word():
        return rng.choice(common) if rng.random() < 0.5 else made(1, 4)

    def prose(low, high):
        out = ""
        for k in range(rng.randint(low, high)):
            w = word()
            out += (rng.choice((" ", " ", " ", " ", ", ", ". ", "\n", " | ", " - ")) if k else "") + (w.capitalize() if rng.random() < 0.2 or k == 0 and rng.random() < 0.6 else w)
        return out

    def signed():
        marks = rng.sample("#*$%&<>|!_=+~-/", rng.randint(1, 5))
        return " ".join(word() + rng.choice(("", ",", ".")) + rng.choice(marks) * rng.randint(1, 4) for _ in range(rng.randint(3, 8)))

    def shouted():
        marks = rng.choice(("", "!", "!!", "!!", "!!!"))
        return " ".join(word() + rng.choice(("", "", ",", ".")) + marks for _ in range(rng.randint(4, 9))).upper()

    def repeated():
        one = rng.choice((word(), f"{word()}{rng.choice('.,')}", f"{word()} {word()}"))
        return " ".join([rng.choice((one, one.capitalize(), one.capitalize(), one.capitalize()))] * rng.randint(4, 20))

    def key():
        while True:
            value = of(rng.choice((digits + "abcdef", digits + "ABCDEF", alnum)), rng.choice((12, 16, 20, 24, 32, 40, 40, 64)))
            if re.search(r"\d", value) and re.search("[A-Za-z]", value):
                return value

    def grouped():
        letters, size = rng.choice((alnum, alnum, digits + small.upper(), digits + small, digits + "abcdef")), rng.choice((4, 4, 5, 5, 6, 8))
        return rng.choice("----_").join(of(letters, size) for _ in range(rng.randint(3, 6)))

    def uuid():
        return "-".join(of(digits + "abcdef", n) for n in (8, 4, 4, 4, 12))

    def password():
        style = rng.randrange(5)
        if style < 2:
            return "".join(made(2, 2) for _ in range(rng.randint(2, 5)))
        if style == 2:
            return of(small, rng.randint(8, 20))
        if style == 3:
            return "".join(made(1, 2).capitalize() for _ in range(rng.randint(2, 3)))
        return made(2, 3) + rng.choice(("-", "_", "!", "#", "")) + rng.choice((made(1, 2), str(rng.randrange(10, 9999)))) + rng.choice(("", "!"))

    def name():
        first = rng.choice(given) if rng.random() < 0.6 else made()
        last = [made(2, 3).capitalize()]
        if rng.random() < 0.12:
            last.append("-" + made().capitalize())
        if rng.random() < 0.08:
            last[0] = "O'" + last[0]
        middle = f" {rng.choice(small.upper())}." if rng.random() < 0.12 else f" {rng.choice(given).capitalize()}" if rng.random() < 0.1 else ""
        return f"{first.capitalize()}{middle} {''.join(last)}"

    def address():
        number = str(rng.randint(1, 9999)) + (rng.choice("abAB") if rng.random() < 0.1 else "")
        street = " ".join(made(1, 3).capitalize() for _ in range(rng.choice((1, 1, 1, 2))))
        style = rng.randrange(8)
        if style < 5:
            kind = rng.choice("Street St Avenue Ave Road Rd Lane Ln Drive Boulevard Court Way Place Square Terrace Crescent Close".split())
            out = f"{number} {street} {kind}"
        elif style == 5:
            out = f"{made().capitalize()}{rng.choice(('strasse', 'straße'))} {number}" if rng.random() < 0.6 else f"{made().capitalize()} {rng.choice(('Weg', 'Platz', 'Allee', 'Gasse'))} {number}"
        elif style == 6:
            out = f"{number} {rng.choice(('rue', 'Rue', 'avenue'))} {rng.choice(('de', 'de la', 'du', ''))} {street}".replace("  ", " ")
        else:
            out = f"{rng.choice(('Calle', 'Avenida', 'Plaza', 'Via'))} {street} {number}"
        if rng.random() < 0.15:
            out += f", {rng.choice(('Apt', 'Suite', 'Unit', 'Floor'))} {rng.randint(1, 99)}"
        if rng.random() < 0.45:
            city = " ".join(made(2, 3).capitalize() for _ in range(rng.choice((1, 1, 2))))
            out += rng.choice((f", {city}", f", {city}, {of(small.upper(), 2)} {of(digits, 5)}", f", {of(digits, 5)} {city}", f", {city} {of(digits, 5)}"))
        return out

    def cased(cue):
        return rng.choice((cue, cue, cue.upper(), cue.capitalize()))

    def cued(cue, value):
        sign, quote = rng.choice((" = ", ": ", "=", ":", " : ", " is ", ": ")), rng.choice(('"', "'", "", ""))
        return [(f"{cased(cue)}{sign}{quote}", False), (value, True), (quote, False)]

    def lookalike():
        title = " ".join(made(1, 3).capitalize() for _ in range(rng.randint(1, 4)))
        return rng.choice((
            lambda: f"{rng.choice(('number', 'id', 'the', 'see', 'card', 'on', '=', ':', 'in', 'paid', 'call'))} {rng.randrange(10**rng.randint(2, 15), 10**16)}",
            lambda: f"{rng.choice(('number', 'id', 'the', 'see', 'for', 'order'))} " + rng.choice((
                f"version{rng.randrange(10**4)}", f"Model{rng.randrange(1000, 9999)}X", f"{rng.randrange(1900, 2030)}01{rng.randrange(10, 28)}",
                f"page{rng.randrange(10**5)}", "internationalisation2", f"mp{rng.randrange(10**6)}player", of("ABCDEFGHJK0123456789", rng.choice((8, 9, 10, 11))))),
            lambda: f"{rng.randint(1, 31)} {rng.choice('January March April May June July August October'.split())} {rng.randint(1900, 2030)}",
            lambda: f"{rng.randint(1900, 2030)}-{rng.randint(10, 12)}-{rng.randint(10, 28)}, {rng.randint(1, 99)}-{rng.randint(1, 99)}",
            lambda: f"{rng.choice(('the', 'a', 'in', 'of', 'under', 'by'))} {title}",
            lambda: f"{rng.choice(('Chapter', 'Section', 'Figure', 'Table', 'Version', 'Page', 'Step'))} {rng.randint(1, 99)} {title}",
            lambda: f"{rng.randint(2, 999)} {made().capitalize()} {rng.choice(('items', 'people', 'years', 'pages', 'Men', made(), made().capitalize()))}",
            lambda: f"Licensed under the {title} License, Version {rng.randint(1, 9)}.{rng.randint(0, 9)}",
            lambda: f"{rng.choice(('Home', 'About', 'Login', 'News'))} | {title} | {rng.choice(('Contact', 'Help', 'Search'))} | {made().capitalize()}",
            lambda: f"{rng.choice(('the ', '', '. '))}{cased(rng.choice(('st', 'street', 'road', 'way', 'place', 'square', 'drive', 'court', 'name', 'address', 'key', 'token', 'password', 'secret')))}{rng.choice((' ', '. '))}{word()} {word()}",
            lambda: f"{cased(rng.choice(('password', 'token', 'key', 'secret', 'name', 'address')))} {rng.choice(('reset', 'of', 'is', 'was', 'and', 'for', 'must', 'bar', 'field', 'required', 'changed', 'to'))} {word()}",
            lambda: f"{cased(rng.choice(('password', 'token', 'name', 'address', 'key', 'contact')))}{rng.choice((':', ' ='))} {rng.choice(('required', 'optional', 'see', 'none', 'the', 'a', 'not', 'yes', 'no', 'string', 'null', 'true'))} {word()}",
            lambda: f"{made()}-{made()}-{made()} {made()}-{made()}",
            signed, signed, shouted, shouted, repeated, repeated, repeated, repeated,
            lambda: f"{rng.choice(('under', 'Licensed under', 'see', 'by'))} {of(small.upper(), 2)} {of(small.upper(), 2)}-{of(small.upper(), 2)} {rng.randint(1, 9)}.{rng.randint(0, 9)}",
            lambda: f"{rng.choice(('note', 'see', 'example', 'title', 'date', 'summary', 'total', 'time'))}: {rng.choice((title, made(), prose(2, 5), str(rng.randrange(10**6))))}",
            lambda: rng.choice((of(small, rng.randint(8, 14)), made(4, 5))),
            lambda: made(1, 2).capitalize() + ". " + prose(1, 6).capitalize() + ". " + made(1, 3).capitalize(),
        ))()

    people = ("name", "full name", "contact", "customer", "recipient", "patient", "client", "attn", "employee", "owner", "billed to", "signed by", "my name is", "Mr.", "Mrs.", "Ms", "Dr.", "Dear", "Best regards,", "Herr", "Frau", "Monsieur", "Señora")
    homes = ("address", "home address", "ship to", "lives at", "living at", "deliver to", "located at", "street address", "mail to", "resident of", "Adresse", "dirección", "adresse", "moved to")
    while True:
        for kind in ("key", "key", "key", *["password"] * 8, "grouped", "grouped", "uuid", "uuid", "name", "name", "address", "address", "both", *["none"] * 14):
            lead, tail = prose(0, 5), prose(0, 4)
            if kind == "key":
                parts = cued(rng.choice("token secret password key api_key apikey access auth bearer passwd credential".split() + ["api key", "access token", "secret key"]), key())
            elif kind == "password":
                parts = cued(rng.choice(("password", "password", "passwd", "pwd", "passphrase", "passphrase", "secret", "login password", "Passwort", "contraseña", "pass")), password())
            elif kind == "grouped":
                parts = cued(rng.choice(("license key", "product key", "serial", "activation code", "key", "api key", "token", "recovery code", "backup code", "secret")), grouped())
            elif kind == "uuid":
                parts = cued(rng.choice(("uuid", "token", "session", "session id", "api key", "client secret", "key", "user id", "secret")), uuid())
            elif kind == "name":
                cue = rng.choice(people)
                sign = rng.choice((": ", " = ", " ", " is ", ": ")) if cue.islower() else " "
                parts = [(f"{cased(cue) if cue.islower() else cue}{sign}", False), (name(), True)] if rng.random() < 0.75 else [("", False), (f"{rng.choice(given).capitalize()} {made(2, 3).capitalize()}", True)]
            elif kind == "address":
                cue = f"{cased(rng.choice(homes))}{rng.choice((': ', ' ', ' ', ' is '))}" if rng.random() < 0.7 else ""
                parts = [(cue, False), (address(), True)]
            elif kind == "both":
                cue = f"{rng.choice(people)} " if rng.random() < 0.5 else ""
                parts = [(cue, False), (name(), True), (rng.choice((", ", ", ", "\n", " lives at ", ", address: ")), False), (address(), True)]
            else:
                parts = [(lookalike() if rng.random() < 0.8 else prose(5, 14), False)]
            before = (lead + rng.choice((" ", " ", ". ", "\n", ", "))) if lead else ""
            after = (rng.choice((" ", " ", ". ", ". ", ". ", ", ", "\n", "; ")) + tail) if tail else rng.choice(("", "."))
            yield [(before, False), *parts, (after, False)]


def labelled_table() -> list[tuple[list[str], list[int]]]:
    """Sentences as tokens with their labels: 0 outside, 1 begins a secret, 2 continues it."""
    rows = []
    for parts in islice(_sentences(random.Random(11)), 2000):
        text = "".join(p for p, _ in parts)
        tokens, labels, at, spans = [], [], 0, []
        for part, secret in parts:
            if secret:
                spans.append((at, at + len(part)))
            at += len(part)
        for m in _TOKEN.finditer(text):
            a = m.start() + m.group()[0].isspace()
            own = next(((x, y) for x, y in spans if x <= a < y), None)
            tokens.append(m.group())
            labels.append(0 if own is None else 1 if own[0] == a else 2)
        if len(tokens) <= 40:  # the longest sets the cost of training
            rows.append((tokens, labels))
    return rows


class Crf:
    """Weights of features by label and of steps between labels."""

    def __init__(self, index: dict[str, int], emit: np.ndarray, step: np.ndarray):
        self.index, self.emit, self.step = index, emit, step

    def emissions(self, features: list[list[str]]) -> np.ndarray:
        out = np.zeros((len(features), 3))
        rows = [(i, self.index[f]) for i, fs in enumerate(features) for f in fs if f in self.index]
        if rows:
            at, which = np.array(rows).T
            np.add.at(out, at, self.emit[which])
        return out

    def decode(self, emissions: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Best labels of runs laid end to end, each between two tokens that are outside.

        All runs go one token ahead at a time; the few that are longer than the rest are finished one by one.
        """
        begins = np.cumsum(lengths) - lengths
        order = np.argsort(-lengths, kind="stable")
        begins, sizes = begins[order], lengths[order]
        longest = int(sizes[0]) if len(sizes) else 0
        best = emissions[begins] + self.step[0]
        best[:, 2] = -np.inf
        back = []
        ended = np.zeros((len(sizes), 3))
        for t in range(1, longest + 1):
            live = int(np.searchsorted(-sizes, -t, "right"))  # runs of t tokens or more
            going = int(np.searchsorted(-sizes, -(t + 1), "right"))
            ended[going:live] = best[going:live]
            if going <= _FEW:
                break
            paths = best[:going, :, None] + self.step[None]
            paths[:, 0, 2] = -np.inf
            back.append(paths.argmax(axis=1))
            best = np.concatenate([paths.max(axis=1) + emissions[begins[:going] + t], best[going:]])
        out = np.zeros(len(emissions), np.int64)
        label = (ended + self.step[:, 0]).argmax(axis=1)
        if longest:
            for run in range(going):
                rest = slice(begins[run] + t, begins[run] + sizes[run])
                label[run], out[rest] = self._finish(best[run].tolist(), emissions[rest])
            longest = t
        for t in range(longest - 1, -1, -1):
            live = int(np.searchsorted(-sizes, -(t + 1), "right"))
            out[begins[:live] + t] = label[:live]
            if t:
                label[:live] = back[t - 1][np.arange(live), label[:live]]
        return out

    def _finish(self, best: list[float], emissions: np.ndarray) -> tuple[int, np.ndarray]:
        """Best label of the token before and those of a run's other tokens: the sums and ties of ``decode``."""
        (s00, s01, _), (s10, s11, s12), (s20, s21, s22) = self.step.tolist()
        b0, b1, b2 = best
        back = bytearray()
        for at in range(0, len(emissions), 1 << 14):
            for e0, e1, e2 in emissions[at : at + (1 << 14)].tolist():
                p, x, y = 0, b0 + s00, b1 + s10
                if y > x:
                    p, x = 1, y
                y = b2 + s20
                if y > x:
                    p, x = 2, y
                q, u, y = 0, b0 + s01, b1 + s11
                if y > u:
                    q, u = 3, y
                y = b2 + s21
                if y > u:
                    q, u = 6, y
                r, v, y = 9, b1 + s12, b2 + s22  # a secret does not go on after a token outside
                if y > v:
                    r, v = 18, y
                b0, b1, b2 = x + e0, u + e1, v + e2
                back.append(p + q + r)
        ends = (b0 + s00, b1 + s10, b2 + s20)
        label = ends.index(max(ends))
        labels = bytearray(len(back))
        for k in range(len(back) - 1, -1, -1):
            labels[k] = label
            label = back[k] // (1, 3, 9)[label] % 3
        return label, np.frombuffer(labels, np.uint8)


@lru_cache(maxsize=1)
def train(rounds: int = 150, decay: float = 1e-3) -> Crf:
    """Weights of largest penalised likelihood, by forward and backward sums over all sentences at once."""
    table = labelled_table()
    features = [[_features(t[max(0, i - 3) : i], t[i], t[i + 1 : i + 3]) for i in range(len(t))] for t, _ in table]
    often = Counter(f for s in features for token in s for f in token)
    index = {f: i for i, f in enumerate(sorted(f for f, c in often.items() if c >= 4))}  # rarer ones would be learnt by heart
    n, longest = len(table), max(len(t) for t, _ in table)
    real = np.zeros((n, longest), bool)
    gold = np.zeros((n, longest), np.int64)
    rows = []
    for i, (tokens, labels) in enumerate(table):
        real[i, : len(tokens)] = True
        gold[i, : len(tokens)] = labels
        rows += [(i * longest + k, index[f]) for k, fs in enumerate(features[i]) for f in fs if f in index]
    cell, which = np.array(rows).T
    emit, step = np.zeros((len(index), 3)), np.zeros((3, 3))
    moments = [np.zeros_like(emit), np.zeros_like(emit), np.zeros_like(step), np.zeros_like(step)]
    ban = np.zeros((3, 3))
    ban[0, 2] = -1e4

    def total(x, axis):
        top = x.max(axis=axis, keepdims=True)
        return np.log(np.exp(x - top).sum(axis=axis)) + top.squeeze(axis)

    for r in range(1, rounds + 1):
        scores = np.stack([np.bincount(cell, emit[which, y], n * longest) for y in range(3)], axis=1).reshape(n, longest, 3)
        moves = step + ban
        forward, backward = np.zeros_like(scores), np.zeros_like(scores)
        forward[:, 0] = scores[:, 0] + moves[0]
        for t in range(1, longest):
            ahead = total(forward[:, t - 1, :, None] + moves[None], 1) + scores[:, t]
            forward[:, t] = np.where(real[:, t, None], ahead, forward[:, t - 1])
        for t in range(longest - 2, -1, -1):
            behind = total(moves[None] + (scores[:, t + 1] + backward[:, t + 1])[:, None, :], 2)
            backward[:, t] = np.where(real[:, t + 1, None], behind, 0)
        mass = total(forward[:, -1], 1)
        marginal = np.where(real[..., None], np.exp(forward + backward - mass[:, None, None]), 0)
        slope = -marginal
        i, k = np.nonzero(real)
        slope[i, k, gold[i, k]] += 1
        grads = np.stack([np.bincount(which, slope.reshape(-1, 3)[cell, y], len(index)) for y in range(3)], axis=1) - decay * n * emit
        pair = np.exp(forward[:, :-1, :, None] + moves + (scores + backward)[:, 1:, None, :] - mass[:, None, None, None]) * real[:, 1:, None, None]
        steps = -pair.sum(axis=(0, 1)) - decay * n * step
        np.add.at(steps, (gold[:, :-1][real[:, 1:]], gold[:, 1:][real[:, 1:]]), 1)
        steps[0, 2] = 0
        for weights, grad, m in ((emit, grads, moments[:2]), (step, steps, moments[2:])):
            m[0][:] = 0.9 * m[0] + 0.1 * grad
            m[1][:] = 0.99 * m[1] + 0.01 * grad * grad
            weights += 0.1 * (m[0] / (1 - 0.9**r)) / (np.sqrt(m[1] / (1 - 0.99**r)) + 1e-8)
    return Crf(index, emit, step)


class _Ids(dict):
    """Ids of tokens; a new token gets one on first use."""

    def __init__(self, new):
        super().__init__()
        self.new = new

    def __missing__(self, token: str) -> int:
        self[token] = i = self.new(token)
        return i


class _Scorer:
    """Emissions of tokens. Each feature rests on one token, so a token's shares for every place are added up once."""

    def __init__(self, crf: Crf):
        self.crf = crf
        self.words = {m.group(2) for m in map(re.compile(r"(-?\d)=(.+)", re.S).fullmatch, crf.index) if m}
        self._empty()

    def _empty(self):
        self.ids, self.chars, self.looks = _Ids(self._new), 0, {}
        self.shares = np.zeros((1024, 1 + len(_PLACES), 3))
        self.shares[0, 1:] = self._sums([[f"{place}="] for place in _PLACES])  # no token

    def _sums(self, lists: list[list[str]]) -> np.ndarray:
        index = self.crf.index
        return np.array([self.crf.emit[[index[f] for f in features if f in index]].sum(axis=0) for features in lists])

    def start(self) -> None:
        """Forget the tokens if there are too many; ids given out before are void."""
        if len(self.ids) > _KNOWN or self.chars > _KNOWN_CHARS:
            self._empty()

    def id_of(self, token: str) -> int:
        return self.ids[token]

    def _new(self, token: str) -> int:
        i = len(self.ids) + 1
        if i == len(self.shares):
            self.shares = np.concatenate([self.shares, np.zeros_like(self.shares)])
        looks = _looks(token)
        known = self.looks.get(looks)
        if known is None:
            known = self.looks[looks] = self._sums([_own(looks), *(_near(place, looks) for place in _PLACES)])
        self.shares[i] = known
        word = token.strip().lower()
        if word in self.words:
            self.shares[i] += self._sums([[f"{place}={word}"] for place in (0, *_PLACES)])
        self.chars += len(token)
        return i

    def emissions(self, ids: np.ndarray, begin: int, end: int) -> np.ndarray:
        """Of the tokens from ``begin`` to ``end`` of ids that have three zeros at both ends."""
        shares = self.shares.take(ids[begin - 3 : end + 2], axis=0)  # all places of a token lie together
        out = shares[3 : len(shares) - 2, 0].copy()
        for k, place in enumerate(_PLACES, 1):
            out += shares[3 + place : len(shares) - 2 + place, k]
        for k in _SAME:
            if f"same {k}" in self.crf.index:
                out[ids[begin:end] == ids[begin - k : end - k]] += self.crf.emit[self.crf.index[f"same {k}"]]
        return out


def _tokens(text: str):
    return _TOKEN.findall(text) if len(text) <= _TOGETHER else (m.group() for m in _TOKEN.finditer(text))


def _may_be_inside(step: np.ndarray, scores: np.ndarray) -> np.ndarray:
    """Which of all tokens but the last may have another label than 0 on a best path.

    A label is ruled out where putting 0 for it raises every path. If the next label is 2, it becomes 1 then.
    """
    after = scores[1:, 2] - scores[1:, 1] + (step[2] - step[1]).max()
    out = np.zeros(len(scores) - 1, bool)
    for label in (1, 2):
        earlier = (step[label - 1 :, label] - step[label - 1 :, 0]).max() if label == 2 else (step[:, 1] - step[:, 0]).max()
        later = np.maximum((step[label, :2] - step[0, :2]).max(), step[label, 2] - step[0, 1] + after)
        out |= scores[:-1, label] - scores[:-1, 0] + earlier + later >= -1e-9
    return out


def _labels(scorer: _Scorer, values: list[str]):
    """Numbers of the first tokens of the texts, and the numbers and labels of all tokens that are not outside."""
    scorer.start()
    ids, begins, at = [np.zeros(3, np.int32)], [], 3
    for value in values:
        begins.append(at)
        own = np.fromiter(map(scorer.ids.__getitem__, _tokens(value)), np.int32)
        ids += [own, np.zeros(3, np.int32)]
        at += len(own) + 3
    ids = np.concatenate([*ids, np.zeros(1, np.int32)])
    places, scores = [], []
    for begin in range(3, at - 3, _SCORED):
        end = min(begin + _SCORED, at - 3)
        some = scorer.emissions(ids, begin, end + 1)  # and the one after
        live = np.flatnonzero(_may_be_inside(scorer.crf.step, some) & (ids[begin:end] > 0))
        places.append(live + begin)
        scores.append(some[live])
    places = np.concatenate(places) if places else np.empty(0, np.int64)
    if not len(places):
        return begins, places, places
    cuts = np.flatnonzero(np.diff(places) > 1) + 1
    labels = scorer.crf.decode(np.concatenate(scores), np.diff(np.concatenate([[0], cuts, [len(places)]])))
    return begins, places[labels > 0], labels[labels > 0]


def secrets(scorer: _Scorer, values: list[str]) -> list[list[tuple[int, int]]]:
    """Spans of secrets of several texts, decoded together over all their tokens."""
    begins, places, labels = _labels(scorer, values)
    cuts = np.searchsorted(places, [*begins, np.iinfo(np.int64).max])
    out = []
    for value, begin, low, high in zip(values, begins, cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        spans: list[list[int]] = []
        if low < high:
            wanted = dict(zip((places[low:high] - begin).tolist(), labels[low:high].tolist(), strict=True))
            last = max(wanted)
            for k, m in enumerate(islice(_TOKEN.finditer(value), last + 1)):
                label = wanted.get(k)
                if label == 1:
                    spans.append([m.start() + m.group()[0].isspace(), m.end()])
                elif label == 2:
                    spans[-1][1] = m.end()
        out.append([(a, b) for a, b in spans])
    return out


def _outside(a: int, b: int, base: list[tuple[int, int, int]]):
    """What base spans, sorted by their beginnings, leave of a secret."""
    for x, _, y in base:
        if x < b and a < y:
            if a < x:
                yield a, x
            a = max(a, y)
    if a < b:
        yield a, b


def _all_spans(crf: Crf | _Scorer, values: list[str]):
    """Base spans and all spans of each text; of a secret that meets base spans, what they leave of it counts."""
    scorer = crf if isinstance(crf, _Scorer) else _Scorer(crf)
    at = 0
    while at < len(values):
        end, chars = at, 0
        while end < len(values) and (end == at or chars + len(values[end]) <= _TOGETHER):
            chars += len(values[end])
            end += 1
        some = values[at:end]
        for value, hidden in zip(some, secrets(scorer, some), strict=True):
            base = base_spans(value)
            more = [(x, 4, y) for a, b in hidden for x, y in _outside(a, b, base) if any(c.isalnum() for c in value[x:y])]
            yield base, sorted([*base, *more])
        at = end


def _joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


_AT_ONCE = 256


def find_pii(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts, digest and spans of every row. Null and empty texts have none; rows are judged one by one."""
    crf = train()

    def find(batches):
        scorer = _Scorer(crf)
        for batch, values in each_text(batches):
            keys = batch.column("doc_id")
            for at in range(0, batch.num_rows, _AT_ONCE):
                some = [v for _, v in zip(range(_AT_ONCE), values, strict=False)]
                rows = []
                for base, every in _all_spans(scorer, some):
                    counts = np.bincount([k for _, k, _ in every], minlength=5) if every else np.zeros(5, np.int64)
                    rows.append((*counts.tolist(), hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(every)))
                names = ["n_email", "n_ip", "n_card", "n_phone", "n_secret", "base_sha256", "spans"]
                yield pa.RecordBatch.from_arrays([keys.slice(at, len(some)), *(pa.array(c) for c in zip(*rows, strict=True))], ["doc_id", *names])

    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, n_secret long, base_sha256 string, spans string"
    return texts(docs, key, text).mapInArrow(find, schema).select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_secret")


def redact(docs: DataFrame) -> DataFrame:
    """The documents with every span replaced by its kind in brackets; ``n_chars`` follows the text.

    A null text stays null. Overlapping spans become one replacement of the first one's kind.
    """
    crf = train()

    def replace(batches):
        scorer = _Scorer(crf)
        for batch in batches:
            values = batch.column("text").to_pylist()
            new = []
            for at in range(0, len(values), _AT_ONCE):
                some = values[at : at + _AT_ONCE]
                for value, (_, every) in zip(some, _all_spans(scorer, [v or "" for v in some]), strict=True):
                    out, end = [], 0
                    for a, k, b in every:
                        if a >= end:
                            out += [value[end:a], f"[{KINDS[k].upper()}]"]
                        end = max(end, b)
                    new.append(value if not every else "".join([*out, value[end:]]))
            yield batch.set_column(batch.schema.get_field_index("text"), "text", pa.array(new, pa.string()))

    changed = docs.mapInArrow(replace, docs.schema)
    return changed.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long"))).select(*docs.columns)
