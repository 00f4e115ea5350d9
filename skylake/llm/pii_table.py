"""A small labelled table for the personal-data model: sentences in four languages with marked spans.

A slot `{kind}` in a sentence is filled with values of that kind; each sentence comes ROUNDS times with different ones. Sentences
without a slot teach what is none: dates, prices, versions, references, hashes, titles, addresses of machines. INVENTED lines of
words that do not exist and some that do, with capitals and numbers, teach that an unknown word is no name by itself.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession

ROUNDS = 3
INVENTED = 320
_GIVEN = "Anna Peter Maria John Sofia Lucas Emma David Clara Hugo Elena Tom Ingrid Pablo Claire Samuel Yara Oskar Lea Marc Zoë André".split()
_FAMILY = "Berger Novak Smith Moreau García Weber Jones Martin Castillo Lindgren Fischer Brown Petit Ortega Keller Walsh Álvarez Okafor O'Neill Meyer-Lund".split()
_HOSTS = "example sample mailbox corp uni post".split()
_ENDS = "com org net de fr es".split()

_SENTENCES = """
My name is {name} and I live in the north.
my name is {name}, nice to meet you
Please contact {name} for details.
Please contact {name} at {phone} or write to {email}.
Dear {name}, thank you for your letter.
Dear Mr. {name}, your order has been sent.
Mr. {name} signed the lease in May.
Mrs. {name} called the office twice.
Dr. {name} will see you now.
Ask Dr. {name} for a date.
Hello, this is {name} from the bank.
I am {name}, the new neighbour.
Ich bin {name} aus dem Haus.
Contact {name} on {phone}
Tel.: {phone}
Write to {name} at {email}
Mein Name ist {name}, Telefon {phone}.
Este es {name}, teléfono {phone}
Herr {name} und Frau {name} sind da.
Frau {name} wohnt hier.
Herr {name} wohnt in der Stadt.
Reach us at {phone}
Signed by {name} on the last page.
The patient {name} was admitted yesterday.
Name: {name}
Name: {name}, phone: {phone}
Full name: {name}; passport {id}
Employee {name} has the number {id}.
Call me at {phone} after six.
You can reach me on {phone} at any time.
Phone: {phone}
Tel. {phone}
Telephone {phone}, ask for {name}.
My phone number is {phone}, please call.
Mobile: {phone} (evenings only)
Fax {phone}
Text me on {phone} when you arrive.
His social security number is {id}.
SSN: {id}
SSN {id} belongs to {name}.
My passport number is {id}.
My passport number is {id}
The passport number of {name} is {id}.
Mein Name ist {name} und ich bin neu.
Mein Name ist {name}!
His email is {email} and that is all.
Passport no. {id}, issued in 2011
IBAN: {id}
Send the money to IBAN {id} today.
Driver license {id}
Write to {email} for the list.
Email: {email}
My email is {email} if you need it.
E-mail me at {email} please.
contact us: {email}
Ich heiße {name} und wohne hier.
Mein Name ist {name}.
Herr {name} kommt morgen.
Frau {name} hat angerufen.
Sehr geehrte Frau {name}, vielen Dank.
Telefon: {phone}
Meine Telefonnummer ist {phone}.
Rufen Sie {name} unter {phone} an.
Ausweis {id}
Steuernummer: {id}
Schreiben Sie an {email} bitte.
Je m'appelle {name} et je suis ici.
Monsieur {name} est absent.
Madame {name} a signé hier.
Téléphone : {phone}
Mon numéro de téléphone est {phone}.
Numéro de passeport : {id}
Écrivez à {email} merci.
Me llamo {name} y vivo aquí.
El señor {name} no está.
La señora {name} ha llamado.
Teléfono: {phone}
Mi número de teléfono es {phone}.
Mi pasaporte es {id}.
Escriba a {email} por favor.
The meeting is on 2021-03-14 at 10:30 in room 204.
It costs 1,299.00 dollars or 1.150,50 euros.
Version 3.11.4 was released after 3.10.
Call the function twice and read line 120.
The phone was invented long ago.
Order 4711-0815-22 has 12 items.
Section 12.3.4 of the report has 240 pages.
In 1998 and 2003 there were 1500 and 17000 cases.
He said that Monday is fine and Tuesday is not.
The United Nations met in New York in June.
A Short History Of The World was on the table.
THIS IS A WARNING IN CAPITAL LETTERS!!
THE NAME OF THE GAME IS ALL WE KNOW!!
Copyright 2019 The Authors. All rights reserved.
Licensed under the Apache License, Version 2.0.
See https://www.example.com/path/page?id=123456 for more.
commit 8b540ef2c226668020056c2469c653445539f8d7
token = "9f8e7d6c5b4a39281706f5e4d3c2b1a0"
password: hunter2hunter2
The number 4587129034567812 is not one to call.
Numbers 5927243074273351 and 3 5 8 13 21 34 55 are here.
Total: 4507129034567812
Order number: 83920174658392
Sum: 12345678
Count: 98765432101
Le Grand Livre est sur la table.
El Gran Libro es nuevo.
Die Neue Welt ist da.
Add 12 34 56 78 and 90 to get the sum.
Results: 12-3, 4-5 and 6-7.
The ratio is 555 to 1234 in the second column.
Chapter 1 The Beginning. Chapter 2 The End.
Where is it? There. And What Then? Nothing, Said The Old Man.
The name of the town is not known.
He went to. Then he came from. Where To? There he is to. Come on.
Look at the dot at the end of the line.
We met at noon at the house.
He came at example time and left at once.
Mr. and Mrs. were printed on the door.
Dear all, the plan is done.
Dear customer, please wait.
A passport is needed at the border.
My email is not working today.
Email: see below
Phone: none
Das Haus ist alt und die Straße ist lang.
Am 12.05.2020 um 14:30 Uhr war es kalt.
Der Name der Stadt ist unbekannt.
Die Frau und der Herr sind im Haus.
Le prix est de 12,50 euros en 2015.
La maison est grande. Le Jardin Aussi.
Le nom de la ville est inconnu.
El precio es de 12,50 euros en 2015.
La casa es grande. El Jardín También.
El nombre de la ciudad es otro.
Ips 999.300.1.2 and 10.0.0 are no addresses.
Line one | line two | Line Three | LINE FOUR
"""


def _values(rng: np.random.Generator) -> dict[str, Iterator[str]]:
    pick = lambda of: of[int(rng.integers(len(of)))]
    digits = lambda shape: "".join(str(rng.integers(10)) if c == "0" else c for c in shape)
    letters = lambda shape: "".join("ABCDEFGHJKLMNPRSTUVWXYZ"[int(rng.integers(23))] if c == "A" else c for c in digits(shape))
    spelled = ("{0} at {1} dot {2}", "{0} dot {3} at {1} dot {2}", "{0} (at) {1} (dot) {2}", "{0}.{3} [at] {1} [dot] {2}", "{0} AT {1} DOT {2}", "{0}{4} at {1} dot {2}")
    phones = ("(000) 000-0000", "000-000-0000", "000-0000", "000 0000000", "00 00 00 00 00", "0000 000 000", "000.000.0000", "0000/0000000", "000 00 00 00", "00000 000000")
    ids = ("000-00-0000", "A00A00A00", "A0000000", "AA00 0000 0000 0000 0000 00", "A0000000A", "AA000000A", "00 000 000 000", "AA0000000000000000", "000000000")
    made = {
        "name": lambda: pick((pick(_GIVEN) + " " + pick(_FAMILY), pick(_GIVEN) + " " + pick(_FAMILY), pick(_FAMILY), f"{pick(_GIVEN)} {letters('A')}. {pick(_FAMILY)}")),
        "phone": lambda: digits(pick(phones)),
        "id": lambda: letters(pick(ids)),
        "email": lambda: pick(spelled).format(pick(_GIVEN).lower(), pick(_HOSTS), pick(_ENDS), pick(_FAMILY).lower(), digits("00")),
    }
    return {kind: iter(make, None) for kind, make in made.items()}


def rows(rounds: int = ROUNDS, seed: int = 12) -> list[tuple[str, list[tuple[str, int, int]]]]:
    """(text, [(kind, start, end)])."""
    values, out = _values(np.random.default_rng(seed)), []
    for _ in range(rounds):
        for line in _SENTENCES.strip().split("\n"):
            text, spans, at = "", [], 0
            for m in re.finditer(r"\{(name|phone|id|email)\}", line):
                text += line[at:m.start()]
                value, at = next(values[m[1]]), m.end()
                spans.append((m[1], len(text), len(text) + len(value)))
                text += value
            out.append((text + line[at:], spans))
    return out + [(line, []) for line in _invented(np.random.default_rng(seed + 1))]


def _invented(rng: np.random.Generator) -> Iterator[str]:
    syllables = "an ba cho der ei fou gra hin ist jo ké lu men no ör pre qua ra sch tion um ve wi za ñe çà é és ê o the la un".split()
    word = lambda: "".join(rng.choice(syllables, rng.integers(1, 6)))
    plain = re.findall(r"\b[^\W\d_]+\b", " ".join(x.lower() for x in _SENTENCES.split("\n") if "{" not in x))
    for at in range(INVENTED):
        words = [word() if rng.random() < 0.6 else str(rng.choice(plain)) for _ in range(rng.integers(5, 13))]
        for i in np.flatnonzero(rng.random(len(words)) < (0.2, 0.5)[at % 2]):
            w, t = words[i], words[i].capitalize()
            number = "".join(map(str, rng.integers(0, 10, rng.integers(1, 18))))
            words[i] = str(rng.choice([t, t + " " + word().capitalize(), w.upper() + "!!", number, f"{w}.\n{t}", f"{w}. {t}", f"{w}. {t}", f"{w}. {t}", f"{w}, {t}", f"{w},", f"({w})", f"| {t}"]))
        words[0] = words[0][0].upper() + words[0][1:]
        yield " ".join(words) + "."


def labelled(spark: SparkSession, rounds: int = ROUNDS) -> DataFrame:
    return spark.createDataFrame(rows(rounds), "text string, spans array<struct<kind:string,start:bigint,end:bigint>>")
