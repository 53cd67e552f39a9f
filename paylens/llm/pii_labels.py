"""The labelled table of the personal-data tagger: sentences with marked spans."""

from __future__ import annotations

import random

# Invented sentences in four languages; {kind} stands for a span of that kind.
SENTENCES = [
    "Please write to {email} before Friday noon.", "Contact: {email}, {phone}", "Her number is {phone} and her card is {card}.",
    "The server {ip} did not answer for an hour.", "Login from {ip} by {email} was refused.", "Call {phone} or send a mail to {email}.",
    "password={secret}", 'token = "{secret}" in the settings', "export KEY={secret}", "The key {secret} was found in the log.",
    "Paid with {card} on the third day.", "Card {card} , phone {phone} , mail {email}", "{phone}", "{email} {ip} {card}", "{card} {card}",
    "Schreiben Sie an {email} oder rufen Sie {phone} an.", "Der Rechner {ip} ist seit gestern aus.", "Die Karte {card} wurde gesperrt.",
    "Das Passwort lautet {secret} und gilt bis morgen.", "Veuillez appeler le {phone} avant midi.", "Son adresse est {email}, dit-elle.",
    "La carte {card} a été refusée deux fois.", "Le serveur {ip} ne répond plus.", "Escriba a {email} o llame al {phone} hoy.",
    "La tarjeta {card} no es válida.", "El equipo {ip} está apagado, dijo Ana.", "api_key: {secret}",
    "the old password={secret} was left in the file", "und password={secret} ist bekannt", "avec password={secret} dans la liste", "con pwd={secret} en la nota",
    # numbers and marks that are nobody's
    "In 1998 the town had 12,400 people and 3 schools.", "Version 2.10.3 came out on 2021-03-04 at 12:30.", "It costs $5.99, or 20% less.",
    "Licensed under CC BY-NC 4.0.", "See section 3.2.1 on page 42.", "The score was 3:2 (1:1).", "GNU General Public License, version 3.",
    "Wow!! THIS IS GREAT!!! *** $$$ %%% &&&", "ÇA ALORS!! QUE DIRE!! DE!!", "a = b + c - d", "x = 1", "Room 101, Building 7, 80331 München",
    "Order 4711 of 12 May 2020 was shipped.", "The 2 teams met 14 times between 1980 and 1995.", "He ran 100 m in 10.2 s.",
    "The cat sat by the door and waited for rain.", "Der alte Mann ging langsam über die Brücke nach Hause.", "Il pleut souvent dans la ville au printemps.",
    "La niña abrió la ventana y miró al mar.", "Thank you, John! See you (maybe) tomorrow; or not...", '"Never," she said, "not again."',
    "of the tion erth and onnt*** that### with&&& re", "enheit%%% der### die&&& und***", "mail me at the end of the week @ home", "and/or either/or 24/7",
]


def _digits(random_: random.Random, n: int) -> str:
    return "".join(random_.choice("0123456789") for _ in range(n))


def _value(kind: str, r: random.Random) -> str:
    """A made-up span of a kind, in one of the ways people write it."""
    name = lambda: "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(2, 9)))
    if kind == "email":
        left = r.choice(["{a}", "{a}.{b}", "{a}{n}", "{a}.{n}", "{a}_{b}", "{a}-{b}+{b}"]).format(a=name(), b=name(), n=r.randint(1, 99))
        return f"{left}@{name()}{r.choice(['', str(r.randint(1, 9))])}.{r.choice(['example.com', 'org', 'de', 'co.uk'])}"
    if kind == "ip":
        return ".".join(str(r.randint(1, 255)) for _ in range(4))
    if kind == "card":
        d = _digits(r, 16)
        return r.choice([d, d, f"{d[:4]} {d[4:8]} {d[8:12]} {d[12:]}", f"{d[:4]}-{d[4:8]}-{d[8:12]}-{d[12:]}"])
    if kind == "phone":
        d = _digits(r, 10)
        return r.choice([f"+1 ({d[:3]}) {d[3:6]}-{d[6:]}", f"+{d[:2]} {d[2:5]} {d[5:]}", f"+49{d}", f"({d[:3]}) {d[3:6]}-{d[6:]}",
                         f"+33 {d[0]} {d[1:3]} {d[3:5]} {d[5:7]} {d[7:9]}", f"{d[:3]}-{d[3:6]}-{d[6:]}"])
    alphabet, n = r.choice([("0123456789abcdef", 40), ("0123456789abcdef", 18), ("0123456789abcdef", 32),
                            ("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 20), ("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", 24)])
    return r.choice(["", "", "AKIA"] if n == 20 else ["", "", "", "ghp_"]) + "".join(r.choice(alphabet) for _ in range(n))


def labelled(copies: int = 12, seed: int = 3) -> list[tuple[str, list[tuple[str, int, int]]]]:
    """Each sentence ``copies`` times with other values; with its spans as kind, start, end."""
    r, out = random.Random(seed), []
    for _ in range(copies):
        for sentence in SENTENCES:
            text, spans, rest = "", [], sentence
            while "{" in rest:
                before, _, rest = rest.partition("{")
                kind, _, rest = rest.partition("}")
                text += before
                value = _value(kind, r)
                spans.append((kind, len(text), len(text) + len(value)))
                text += value
            out.append((text + rest, spans))
    return out
