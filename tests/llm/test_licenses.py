import random
import re

from folio.llm import licenses as lic
from tests.llm.helpers import crowded, frame, sentence


def grams(text):
    w = re.findall(r"[a-z0-9\x80-\U0010ffff]+", "".join(c.lower() if c.isascii() else c for c in text))
    return set(zip(w, w[1:]))


def brute(text, cut=lic.CUT):
    """Every run of units against every notice."""
    text = text or ""
    units, at = [], 0
    for m in re.finditer(r"\n|(?<=[.!?])(?=[ \t\x0b\x0c\r\n])", text):
        if m.end() > at:
            units.append(text[at:m.end()])
            at = m.end()
    units.append(text[at:])
    best = {}
    for i in range(len(units)):
        for j in range(i + 1, min(len(units), i + 8) + 1):
            a = grams("".join(units[i:j]))
            for name, notice in lic.NOTICES:
                b = grams(notice)
                if a:
                    best[name] = max(best.get(name, 0), 2 * len(a & b) / (len(a) + len(b)))
    return {n: round(d, 9) for n, d in best.items() if d >= cut}


def texts():
    rng = random.Random(3)
    out = [sentence(rng, 30), None, "", "License", "licensed", "MIT License. " * 3]
    for name, notice in lic.NOTICES:
        out += [notice, sentence(rng, 10) + ".\n" + notice.upper() + "\n" + sentence(rng, 10), notice.replace(" ", "\n", 3) + "\nrest " + sentence(rng, 3)]
        w = notice.split(" ")
        out.append(" ".join(w[:len(w) // 2]))
        out.append("Text before. " + notice.replace(",", " , ") + " More text follows here.")
        w.insert(2, "altered")
        out.append(" ".join(w))
    out.append(sentence(rng, 50_000) + "\n" + lic.NOTICES[1][1])
    return list(enumerate(out))


def test_scan_equals_brute_force(spark):
    rows = texts()
    got = {r.doc_id: r for r in lic.scan(frame(spark, rows)).collect()}
    for d, t in rows:
        want = brute(t) if len(t or "") < 5000 else {"Apache-2.0": 1.0}
        found = {x.name: round(x.dice, 9) for x in got[d].licenses}
        assert found == want, t
        if found:
            assert got[d].dice == max(x.dice for x in got[d].licenses) and got[d].license == min(n for n, v in found.items() if v == max(found.values()))
        else:
            assert got[d].license is None and got[d].dice is None


def test_spans_hold_the_notice(spark):
    text = "Éa b c.\nReleased under the MIT License.\nend"
    (r,) = lic.scan(crowded(spark, [(None, text)])).collect()
    (x,) = r.licenses
    assert text.encode()[x.start:x.end].decode() == "Released under the MIT License" and r.doc_id is None


def test_repeated_rows_and_empty_table(spark):
    assert [r.license for r in lic.scan(frame(spark, [(1, lic.NOTICES[1][1])] * 2)).collect()] == ["Apache-2.0"] * 2
    assert lic.scan(frame(spark, [])).collect() == []
