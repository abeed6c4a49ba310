import random
import re

import pytest
from edge import documents

from tallystar.llm import licenses as lic

SCANNER = lic.LicenseScanner(lic.TEMPLATES, lic.BASE_PHRASES, 4, 12, 0.75)
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({c: chr(c + 32) for c in range(65, 91)})


def plain_words(text):
    return WORD.findall(text.translate(LOWER))


def base_places(text):
    found = plain_words(text)
    return sorted((i, label) for phrase, label in lic.BASE_PHRASES for p in [phrase.split()]
                  for i in range(len(found)) if found[i:i + len(p)] == p)


def test_words():
    text = "Ünder THE-MIT_licençe\x7f v2.0 x\x00É"
    assert [w.decode() for w in lic.words(text.encode())] == plain_words(text)


def test_base_places_by_brute_force():
    r = random.Random(4)
    vocabulary = "under the mit license apache version 2 cc by nc x licensed 4 0 UNDER CC-BY".split()
    for _ in range(400):
        text = " ".join(r.choice(vocabulary) for _ in range(r.randint(0, 40)))
        found = SCANNER.scan(text.encode())
        assert sorted(found.base) == base_places(text) and found.n_words == len(plain_words(text))


def test_automaton_knows_every_stretch_and_its_places():
    r = random.Random(5)
    sequences = [[r.randrange(3) for _ in range(r.randint(1, 14))] for _ in range(6)]
    automaton = lic.SuffixAutomaton(sequences)
    stretches = {tuple(s[a:b]) for s in sequences for a in range(len(s)) for b in range(a + 1, len(s) + 1)}
    for stretch in stretches:
        state = 0
        for word in stretch:
            state = automaton.next[state][word]
        ends = {(i, e) for i, s in enumerate(sequences) for e in range(len(stretch), len(s) + 1)
                if tuple(s[e - len(stretch):e]) == stretch}
        assert automaton.ends[state] == ends


@pytest.mark.parametrize("label,template", lic.TEMPLATES)
def test_templates_are_found_in_noise(label, template):
    found = SCANNER.scan(f"{'noise words ' * 30}\n# {template.upper()}\n{'more noise ' * 20}".encode())
    assert [s[0] for s in found.spans] == [label]
    assert found.spans[0][2] == 60 and found.spans[0][4] == 1.0


def test_a_changed_template_is_chained():
    text = lic.TEMPLATES[0][1].replace("free of charge", "at no cost whatever").replace("merge,", "")
    spans = SCANNER.scan(text.encode()).spans
    assert [s[0] for s in spans] == ["mit"] and 0.75 <= spans[0][4] < 1
    assert SCANNER.scan(b"the software is a copy of this and of the license").spans == []


def test_nearby_licences_are_told_apart():
    def labels(text):
        return [s[0] for s in SCANNER.scan(text.encode()).spans]
    assert labels("Licensed under CC BY-SA 4.0.") == ["cc-by-sa"]
    assert labels("This work is licensed under the GNU General Public License, version 2") == ["gpl-2"]


def test_summary_and_edges(spark):
    rows = [(10, "x under the MIT license, Apache License Version 2.0 " * 2, "", "", 0),
            (11, "This work is licensed under the GNU General Public License, version 3.", "", "", 0)]
    got = {r.doc_id: r for r in lic.summary(lic.scan(
        documents(spark).unionByName(documents(spark, rows)))).collect()}
    both = got[10]
    assert (both.n_base, both.first_word, both.last_word, both.base_labels, both.score) == (
        4, 1, 15, "apache-2,mit", 1.0)
    assert (got[11].base_labels, got[11].labels, got[11].score) == ("", "gpl-3", 1.0)
    for i in (2, 3, 6):
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score) == (
            0, 0, None, None, "", "", 0.0)
    assert got[4].n_words == 40_000
    assert lic.summary(lic.scan(documents(spark).limit(0))).count() == 0


def test_a_template_inside_a_longer_one_that_goes_on():
    short, long = "alpha beta gamma delta", "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    scanner = lic.LicenseScanner([("short", short), ("long", long)], [], 4, 12, 0.75)
    assert [s[:4] for s in scanner.scan(b"x alpha beta gamma delta epsilon y").spans] == [("short", 0, 1, 5)]
    assert [s[:4] for s in scanner.scan(f"x {long} y".encode()).spans] == [("long", 1, 1, 11)]
    inner = lic.LicenseScanner([("inner", "gamma delta epsilon zeta"), ("long", long)], [], 4, 12, 0.75)
    got = inner.scan(b"beta gamma delta epsilon zeta eta x gamma delta epsilon zeta").spans
    assert [s[:4] for s in got] == [("inner", 0, 1, 5), ("inner", 0, 7, 11)]
    tiny = lic.LicenseScanner([("tiny", "public domain")], [], 4, 12, 0.75)
    assert [s[:4] for s in tiny.scan(b"in the public domain now").spans] == [("tiny", 0, 2, 4)]
