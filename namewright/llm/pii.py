"""Personal data in whole texts: exact patterns, and a conditional random field over word shapes.

The base kinds ``email``, ``ip``, ``card`` and ``phone`` follow fixed patterns.  Each is anchored at a
character that it needs ("@", "+", a digit) and scanned without backtracking, so long runs cost linear time.

The linear-chain model labels words as outside, beginning or inside of ``person``, ``ssn`` and ``iban``; its features are
the word's shape, its length class, whether it is a cue word or a common given name, lower-case words themselves, and the same of
both neighbours.  It is trained from the small table ``LABELLED`` below.  Every word of every text is decoded; a text is one chain.
Where the model proves a word outside whatever its neighbours' labels are, the chain is cut without changing the best path;
the pieces are decoded by Viterbi in numpy batches.  Spans of the model that overlap a base span are dropped; base spans always stay.

Offsets are code points, ends exclusive.  Null and empty texts have no spans; a null id stays null; repeated
rows are scanned once each; other columns are ignored.
"""

from __future__ import annotations

import re
from array import array
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from namewright.llm.batches import slices
from namewright.llm.crf import Trainer, gathered, marginals, scattered, viterbi

BASE = ("email", "ip", "card", "phone")
MODEL = ("person", "ssn", "iban")
KINDS = (*BASE, *MODEL)
LABELS = ("O", *(f"{p}-{k}" for k in MODEL for p in "BI"))
SPANS = "array<struct<kind string, start long, end long, value string>>"
#: Words scored at a time, words decoded at a time, and words whose class a worker remembers; they bound memory only.
BLOCK, CELLS, REMEMBERED = 1 << 15, 1 << 16, 1 << 17
#: Text bytes handled at a time.
PART_BYTES = 2 << 20

LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]+\Z")
DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
CHAIN = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]++")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

# Words that announce a name or a number, in lower case.
CUES = (
    "mr", "mrs", "ms", "dr", "prof", "name", "contact", "signed", "patient", "attn", "señor", "señora", "sr", "sra",
    "herr", "frau", "monsieur", "madame", "mme", "ssn", "iban",
)

CUE_SET = frozenset(CUES)

#: Common given names, in lower case: a feature of the model, neither needed for a name nor enough for one.
GIVEN = frozenset(
    "james john robert michael william david richard joseph thomas charles daniel matthew anthony mark steven paul andrew george peter "
    "kevin brian edward jason jeffrey ryan jacob eric jonathan stephen larry justin scott benjamin samuel frank alexander patrick jack "
    "henry alan carl arthur oliver harry simon martin mary patricia jennifer linda elizabeth barbara susan jessica sarah karen lisa nancy "
    "betty sandra margaret ashley emily emma laura helen carol ruth lily alice anna anne amy rachel julia sophie kate jane olivia lucy "
    "maria ana carmen elena luis pablo jose juan carlos jorge miguel pedro antonio manuel francisco javier diego fernando rosa isabel lucia "
    "marta sofia jonas lena ingrid hans klaus jürgen stefan wolfgang andreas sabine monika petra claudia heike uwe pierre jean michel "
    "philippe claire nicolas camille julien françois marie isabelle hélène giulia marco luca giovanni ahmed mohammed fatima omar priya "
    "raj wei yuki ivan olga dmitri".split()
)

#: The labelled table: words of {kind words} are labelled, all others are outside.
LABELLED = (
    "Please contact {person Maria Lopez} about the order .",
    "Contact: {person John Smith} or the office .",
    "Contact {person Ana Ruiz} by mail .",
    "Mr. {person Peter Brown} signed the letter .",
    "Dear Mrs. {person Helen Clark} , thank you .",
    "Ms. {person Carol White} will be there .",
    "Dr. {person Alan Grant} and Prof. {person Ruth Bell} spoke .",
    "Signed {person Robert King}",
    "Name: {person Laura Stone}",
    "name: {person David Moore} , date of birth below",
    "Patient: {person Emma Hill} was seen today .",
    "Attn: {person George Wood} , second floor",
    "Señora {person Carmen Vega} llega hoy .",
    "El señor {person Luis Prado} no está .",
    "Sra. {person Elena Mora} y Sr. {person Pablo Gil} firman .",
    "Herr {person Jonas Weber} und Frau {person Lena Koch} kommen .",
    "Frau {person Ingrid Maier} hat angerufen .",
    "Monsieur {person Paul Girard} est absent .",
    "Madame {person Claire Dubois} arrive demain .",
    "Mme {person Sophie Martin} a signé .",
    "The name of the river is old .",
    "We had no contact with the other side .",
    "The contact was lost . The Storm came Later .",
    "In the name of the People .",
    "A patient man waits . Then He Goes .",
    "The treaty was signed in Paris .",
    "A name is a sign . Words follow words .",
    "Stay in contact . Every Day counts .",
    "Her SSN is {ssn 512-44-8210} on file .",
    "ssn: {ssn 219-09-9999}",
    "SSN {ssn 078-05-1120} was used .",
    "The number {ssn 431-22-6054} is secret .",
    "Call 555-0100 or room 12-34 .",
    "Part 12-345-678 is out of stock .",
    "From 1990-12-31 to 2001-01-05 it held .",
    "Pages 100-200 and 12-13 are lost .",
    "IBAN {iban DE89370400440532013000} please .",
    "iban: {iban GB29NWBK60161331926819}",
    "Pay to {iban FR1420041010050500013M02606} today .",
    "My IBAN is {iban ES9121000418450200051332} .",
    "Order A123 of 12 May is DONE .",
    "Version 2.0 and B52 and X1 are out .",
    "Code AB12 and model ZX81 are old .",
    "The House of Lords met The King .",
    "It was 1234567890 and 42 in all .",
    "Licensed under the Apache License , Version 2.0 .",
    "All Rights Reserved . Copyright 2020 The Authors .",
    "Dr. {person Alan Grant} came . The Next Line Is Clean .",
    "Mrs. {person Ruth Bell} left . Every Word Here Is Fine .",
    "A Clean Line Here . Mr. {person Carl Hunt} signed .",
    "Then She Said No . Contact {person Lily Snow} now .",
    "ssn: {ssn 219-09-9998} , said no . A Quiet Street There .",
    "An Old House Stood . IBAN {iban DE89370400440532013001} . The End Came Soon .",
    "Best regards, {person John Smith}",
    "Kind regards, {person Nora Falk}",
    "Regards, {person Daniel Reed}",
    "Sincerely, {person Thomas Wright}",
    "Yours sincerely, {person Olga Petrov}",
    "Please call {person Ana Ruiz} today .",
    "You can call {person Michael Turner} tomorrow .",
    "We met {person Sarah Connor} at the station .",
    "Yesterday {person James Miller} came home .",
    "{person Mary Jones} wrote the report .",
    "{person Pedro Alonso} vive en la casa .",
    "{person Julia Roth} wohnt in der Stadt .",
    "{person Pierre Morel} habite dans la ville .",
    "The book by {person Emily Stone} is new .",
    "It was sent to {person Carlos Mendez} and {person Lucy Hale} .",
    "Ayer vino {person Juan Torres} con {person Marta Nieto} .",
    "Gestern kam {person Hans Vogel} mit {person Petra Lang} .",
    "Hier {person Jean Petit} est venu avec {person Marie Blanc} .",
    "My friend {person Priya Patel} lives here .",
    "The teacher {person William Carter} spoke to {person Karen Hughes} .",
    "I saw {person Steven Ford}, who was late.",
    "Thanks, {person Rachel Green}",
    "Ask {person Omar Haddad} about it .",
    "Best regards from the team .",
    "Kind regards to All .",
    "Please call the office . Call Center Hours Apply .",
    "You can call Customer Service today .",
    "The United States and New York are far .",
    "In New York City we met the Prime Minister .",
    "This work is licensed under the GNU General Public License, version 3.",
    "Copyright The Regents . General Public License Terms .",
    "Die Stadt und der Herbst sind Schön . Und Der Wald .",
    "Das Haus steht in der Nähe . Sich Sich Sich .",
    "La Casa Blanca es grande . El Rey llega .",
    "Les Pays Bas sont loin . La Ville Neuve .",
    "Of Of Of are the . And And And erede .",
    "Orre Orre Orre Orre orantion . Thingen Thingen thing .",
    "Nd, Nd, Nd, Nd, ing ing .",
    "Wher. Wher. Th Th Th inwh .",
    "Tion was than. Es. Of thouen ndat. Äen in zuöpf. Ofreh Alyon here .",
    "Nd ndin the. Thes to be hent. Équeê mentan ou. Osñue que ñado .",
    "Breaking News Today : Market Prices Rise .",
    "Chapter One begins . Section Two Ends .",
    "Monday Morning and Friday Night are busy .",
    "They met in Paris . We came by Train .",
    "The number {ssn 078 05 1120} is on file .",
    "It was {ssn 512 44 8210} then .",
    "Her file says {ssn 219 09 9999} here .",
    "We found {ssn 431-22-6054} in the log .",
    "{ssn 301 12 7788}",
    "Old {ssn 123-45-6780} here .",
    "She gave {ssn 618-22-4410} and left .",
    "{ssn 402-55-9012}",
    "Best regards, {person Zoltan Kovacs}",
    "Kind regards, {person Thandi Ndlovu}",
    "Best regards, {person Wren Ashdown}",
    "My account is {iban DE12 5001 0517 0648 4898 90} and nothing else .",
    "Use {iban AT61 1904 3002 3457 3201} or ask .",
    "Or {iban CH93 0076 2011 6238 5295 7} please .",
    "There were 100 20 mile runs .",
    "Take 300 45 6 and go . See 120 14 2 there .",
    "Rows 12 and 345 with 6789 more .",
    "He has 250 of 12 by 1990 .",
    "Room 101 and 20 chairs . It cost 500 in 2004 .",
    "In 1990 2000 and 2010 it rained . Add 3704 to 0440 .",
    "Send it to {iban DE89 3704 0440 0532 0130 00} today .",
    "Account {iban GB29 NWBK 6016 1331 9268 19} is open .",
    "{iban FR14 2004 1010 0505 0001 3M02 606}",
    "The money went to {iban ES91 2100 0418 4502 0005 1332} then .",
    "Transfer {iban NL91 ABNA 0417 1643 00} now .",
    "The box AB12 2004 was sold .",
    "Model ZX81 and part AB12 1990 are old . NATO and USA and EU .",
)

Span = tuple[int, int, str]  # start, end, kind


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def emails(text: str) -> Iterator[Span]:
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at)):
            yield start, m.end(), "email"
            end = m.end()
        at = text.find("@", max(at + 1, end))


def addresses(text: str) -> Iterator[Span]:
    for m in DOTTED.finditer(text):
        if m.group().count(".") < 3:
            continue
        at, parts = m.start(), m.group().split(".")
        for k in range(0, len(parts) - 3, 4):
            four = parts[k : k + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                yield at, end, "ip"
            at = end + 1


def cards(text: str) -> Iterator[Span]:
    for m in CHAIN.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            yield m.start(), m.end(), "card"


def phones(text: str) -> Iterator[Span]:
    for m in PHONE.finditer(text):
        end = m.end()
        while not text[end - 1].isdigit():
            end -= 1
        if end - m.start() >= 4 and 9 <= sum(c.isdigit() for c in text[m.start() : end]) <= 15:
            yield m.start(), end, "phone"


def base_spans(text: str) -> list[Span]:
    """Spans of the base kinds, by start and then kind as listed."""
    found = list(emails(text)) if "@" in text else []
    found += [*addresses(text), *cards(text)]
    if "+" in text:
        found += phones(text)
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


# ---- the model -------------------------------------------------------------------------------------------------

TRIM = re.compile(r"^[\W_]+|[\W_]+$")
SSN_SHAPE, IBAN_SHAPE = re.compile(r"[0-9]{3}-[0-9]{2}-[0-9]{4}"), re.compile(r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}")


def shape(word: str) -> str:
    """The word's outline: digit runs with their lengths, letter runs by case, other characters as they are."""
    core = TRIM.sub("", word)
    if IBAN_SHAPE.fullmatch(core):
        return "IBAN"
    out, at = [], 0
    for m in re.finditer(r"[0-9]+|[^\W\d_]+", core):
        out.append(core[at : m.start()])
        run = m.group()
        if run[0].isdigit():
            out.append(f"d{min(len(run), 9)}")
        else:
            out.append("Xx" if run[0].isupper() and run[1:].islower() else "X" if run.isupper() else "x" if run.islower() else "M")
        at = m.end()
    return "".join(out)[:24] + core[at : at + 4]


def word_key(word: str) -> tuple[str, int, str, bool, bool, bool, str]:
    """What the features of a word depend on: shape, size, cue, stop, colon, given name, and the word if in lower case."""
    if word.isalpha() and word.islower():
        return "x", min(len(word) // 4, 4), word if word in CUE_SET else "-", False, False, False, word
    core, outline = TRIM.sub("", word), shape(word)
    lower, end = core.lower(), word[-1:]
    cue = lower if lower in CUE_SET else "-"
    given = outline == "Xx" and lower in GIVEN
    return outline, min(len(core) // 4, 4), cue, end in ".!?;" and len(core) > 3, end == ":", given, lower if outline == "x" else ""


def key_features(key: tuple[str, int, str, bool, bool, bool, str]) -> list[str]:
    outline, size, cue, stop, colon, given, lower = key
    found = [f"shape={outline}", f"size={size}", f"cue={cue}", f"tail={'stop' if stop else ''}", f"colon={colon}"]
    return found + ["given"] * given + ([f"word={lower}"] if lower else [])


def word_features(word: str) -> list[str]:
    return key_features(word_key(word))


class Classes(dict):
    """The number of each word's class: words with the same known features score the same."""

    def __init__(self, names: dict[str, int], weights: np.ndarray):
        super().__init__()
        self.names, self.weights = names, weights
        self.known = frozenset(x.split("=", 1)[1] for x in names if ":word=" in x)
        self.numbers: dict[tuple, int] = {}
        self.by_rows: dict[tuple, int] = {}
        self.sums: list[np.ndarray] = []

    def __missing__(self, word: str) -> int:
        key = word_key(word)
        if key[-1] and key[-1] not in self.known:
            key = (*key[:-1], "")
        number = self.numbers.get(key)
        if number is None:
            number = self.number(key)
            if len(self.numbers) < REMEMBERED:
                self.numbers[key] = number
        if len(self) < REMEMBERED:
            self[word] = number
        return number

    def number(self, key: tuple) -> int:
        """Keys whose features are not all known can share a class, so odd words do not make the table grow."""
        own = key_features(key)
        rows = tuple(tuple(self.names[x] for f in own if (x := f"{side}:{f}") in self.names) for side in ("own", "before", "after"))
        number = self.by_rows.setdefault(rows, len(self.sums))
        if number == len(self.sums):
            self.sums.append(np.stack([self.weights[list(r)].sum(axis=0) for r in rows]))
        return number

    def table(self) -> np.ndarray:
        """(side, class, label) scores; the last class is none, for the neighbour beyond a chain's end."""
        return np.stack([*self.sums, np.zeros((3, len(LABELS)))], axis=1)


@dataclass
class Tagger:
    """Feature numbers by name for a word itself and as its neighbours, and the weights."""

    names: dict[str, int]
    weights: np.ndarray
    change: np.ndarray

    def __post_init__(self):
        self.classes = Classes(self.names, self.weights)

    def __reduce__(self):
        return Tagger, (self.names, self.weights, self.change)

    def bounds(self) -> tuple[np.ndarray, np.ndarray]:
        """What the transitions around a word can gain at most by a label instead of outside, before any label but its own inside, and before that."""
        c, n = self.change, len(LABELS)
        gain, inside = np.zeros(n), np.full(n, -np.inf)
        for k in range(1, n):
            before = max([0.0, *(c[a, k] - c[a, 0] for a in range(n) if c[a, k] > -1e8)]) if LABELS[k][0] == "B" else max(
                c[a, k] - c[a, 0] for a in range(n) if c[a, k] > -1e8
            )
            i = LABELS.index("I-" + LABELS[k][2:])
            gain[k] = before + max(0.0, *(c[k, b] - c[0, b] for b in range(n) if LABELS[b][0] != "I"))
            # The inside label that follows becomes a beginning.
            later = max(0.0, *(c[i, b] - c[i - 1, b] for b in range(n) if c[i, b] > -1e8))
            inside[k] = before + c[k, i] - c[0, i - 1] + later
        return gain, inside

    def numbers(self, code: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """Label numbers of words by class; ``begin`` has the first word of each chain (ascending, no empty chains)."""
        n, none = len(code), len(self.classes.sums)
        out = np.zeros(n, np.int8)
        if not n:
            return out
        own, ahead, after = self.classes.table()
        first = np.zeros(n + 1, bool)
        first[begin] = first[n] = True
        prior = np.where(first[:-1], none, np.append(none, code[:-1]))
        next_ = np.where(first[1:], none, np.append(code[1:], none))
        gain, inside = self.bounds()
        into = np.array([LABELS.index("I-" + x[2:]) if k else 0 for k, x in enumerate(LABELS)])
        start = np.where(into > 0, into - 1, 0)
        open_ = np.empty(n, bool)
        for at in range(0, n, BLOCK):
            part = slice(at, min(at + BLOCK + 1, n))
            e = own[code[part]] + ahead[prior[part]] + after[next_[part]]
            turn = np.append(e[1:, into] - e[1:, start], np.zeros((1, len(LABELS))), axis=0)
            most = e - e[:, :1] + np.maximum(gain, inside + turn)
            open_[part] = (most[:, 1:] >= -1e-9).any(axis=1)  # the extra word is done again with the next block
        # Pieces: runs of open words inside a chain, between words that are outside.
        edge = open_ & (first[:-1] | ~np.append(False, open_[:-1]))
        head = np.flatnonzero(edge)
        if not len(head):
            return out
        last = np.flatnonzero(open_ & (first[1:] | ~np.append(open_[1:], False)))
        size = last - head + 1
        order = np.argsort(size, kind="stable")
        at = 0
        while at < len(order):
            # Ascending sizes: as many pieces as fit in CELLS words, one at least.
            fits = size[order[at : at + CELLS]] * np.arange(1, len(order[at : at + CELLS]) + 1)
            take = order[at : at + max(1, int(np.searchsorted(fits, CELLS, side="right")))]
            at += len(take)
            steps = np.arange(size[take[-1]])
            mask = steps < size[take][:, None]
            where = np.minimum(head[take][:, None] + steps, n - 1)
            e = own[code[where]] + ahead[prior[where]] + after[next_[where]]
            e[:, 0] += np.where(first[head[take]][:, None], 0.0, self.change[0])
            e[np.arange(len(take)), size[take] - 1] += np.where(first[last[take] + 1][:, None], 0.0, self.change[:, 0])
            out[where[mask]] = viterbi(e, mask, self.change)[mask]
        return out

    def label(self, chains: list[list[str]]) -> list[list[str]]:
        """Labels of the words of each chain."""
        code = np.fromiter((self.classes[w] for c in chains for w in c), np.int32)
        ends = np.cumsum([len(c) for c in chains], dtype=np.int64)
        starts = ends - [len(c) for c in chains]
        found = self.numbers(code, starts[starts < ends])
        return [[LABELS[k] for k in found[a:b]] for a, b in zip(starts, ends, strict=True)]


def parse_labelled(line: str) -> tuple[list[str], list[str]]:
    words, labels = [], []
    for m in re.finditer(r"\{(\w+) ([^}]*)\}|(\S+)", line):
        if m[1]:
            inside = m[2].split()
            words += inside
            labels += [f"{'I' if k else 'B'}-{m[1]}" for k in range(len(inside))]
        else:
            words.append(m[3])
            labels.append("O")
    return words, labels


def train(labelled: tuple[str, ...] = LABELLED, rounds: int = 60) -> Tagger:
    """Fit the tagger to a labelled table; a table of a few hundred lines takes well under a second."""
    chains = [parse_labelled(x) for x in labelled]
    names: dict[str, int] = {}
    numbers, begin, truth = [], [0], []
    width = max(len(w) for w, _ in chains)
    mask = np.zeros((len(chains), width), bool)
    seen = np.zeros((len(LABELS), len(LABELS)))
    for row, (words, labels) in enumerate(chains):
        code = [LABELS.index(x) for x in labels]
        for k, _ in enumerate(words):
            found = [f"own:{f}" for f in word_features(words[k])]
            found += [f"before:{f}" for f in word_features(words[k - 1])] if k else []
            found += [f"after:{f}" for f in word_features(words[k + 1])] if k + 1 < len(words) else []
            numbers += [names.setdefault(f, len(names)) for f in found]
            begin.append(len(numbers))
        truth += code
        mask[row, : len(words)] = True
        for a, b in zip(code, code[1:], strict=False):
            seen[a, b] += 1
    features, starts, gold = np.array(numbers), np.array(begin), np.eye(len(LABELS))[truth]
    trainer = Trainer(len(names), len(LABELS), rate=0.3, decay=1e-2)
    for _ in range(rounds):
        flat = gathered(trainer.weights, features, starts)
        scores = np.zeros((*mask.shape, len(LABELS)))
        scores[mask] = flat
        p, expected = marginals(scores, mask, trainer.change)
        trainer.step(scattered(gold - p[mask], features, starts, len(names)), seen - expected)
    change = trainer.change.copy()
    # An inside label follows its own beginning or inside only.
    for b, label in enumerate(LABELS):
        if label[0] == "I":
            for a, before in enumerate(LABELS):
                if before[2:] != label[2:]:
                    change[a, b] = -1e9
    return Tagger(names, trainer.weights, change)


WORD = re.compile(r"\S+")


def model_spans(text: str, places: list[tuple[int, int]], labels: list[str]) -> list[Span]:
    """Labelled words as spans, without punctuation at their ends."""
    found: list[list] = []
    for (a, b), label in zip(places, labels, strict=True):
        if label == "O":
            continue
        word = text[a:b]
        core = TRIM.sub("", word)
        if not core:
            continue
        start = a + word.index(core)
        if label[0] == "I" and found and found[-1][2] == label[2:] and a - found[-1][3] <= 2:
            found[-1][1], found[-1][3] = start + len(core), b
        else:
            found.append([start, start + len(core), label[2:], b])
    return [(a, b, k) for a, b, k, _ in found]


def all_spans(texts: list[str | None], tagger: Tagger) -> list[list[Span]]:
    """Base and model spans of each text, by start and then kind."""
    out = [base_spans(t) if t else [] for t in texts]
    code = array("i")
    begin, owner = [], []
    classes = tagger.classes
    for i, text in enumerate(texts):
        at = len(code)
        if text:
            # Long texts are split step by step, so that their words are not all held at once.
            code.extend(map(classes.__getitem__, text.split() if len(text) < PART_BYTES else (m.group() for m in WORD.finditer(text))))
        if len(code) > at:
            begin.append(at)
            owner.append(i)
    labels = tagger.numbers(np.frombuffer(code, np.int32) if code else np.zeros(0, np.int32), np.array(begin, np.int64))
    marked = np.flatnonzero(labels)
    added: dict[int, list[Span]] = {}
    for chain in np.unique(np.searchsorted(begin, marked, side="right") - 1).tolist():
        i, own = owner[chain], labels[begin[chain] : begin[chain + 1] if chain + 1 < len(begin) else len(code)]
        places, kinds = [], []
        for m, k in zip(WORD.finditer(texts[i]), own, strict=True):
            if k:
                places.append(m.span())
                kinds.append(LABELS[k])
        added[i] = model_spans(texts[i], places, kinds)
    for i, spans in added.items():
        base = out[i]
        starts, ends = [b[0] for b in base], list(accumulate((b[1] for b in base), max))
        # Of the base spans that start before a span's end, the one that reaches farthest tells whether any overlaps.
        spans = [s for s in spans if not (k := bisect_left(starts, s[1])) or ends[k - 1] <= s[0]]
        out[i] = sorted(base + spans, key=lambda s: (s[0], KINDS.index(s[2])))
    return out


def find_personal_data(docs: DataFrame, tagger: Tagger | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id`` and ``spans``, an array of (kind, start, end, value)."""
    shared = docs.sparkSession.sparkContext.broadcast(tagger or train())
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.string())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=PART_BYTES):
            texts = batch.column("text").to_pylist()
            spans = [
                [{"kind": k, "start": a, "end": b, "value": text[a:b]} for a, b, k in found]
                for text, found in zip(texts, all_spans(texts, shared.value), strict=True)
            ]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(spans, kind)], ["doc_id", "spans"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(work, f"doc_id long, spans {SPANS}")
