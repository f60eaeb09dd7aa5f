import hashlib
import random
import re

from ledgerloom.llm.private import KINDS, base_spans, digest, find_private, luhn, redact

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def brute(text):
    out = [(0, m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(1, m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m.group())
        if 16 <= len(d) <= 19 and luhn(d):
            out.append((2, m.start(), m.end()))
    out += [(3, m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return out


def test_base_rules():
    random.seed(5)
    for _ in range(4000):
        text = "".join(random.choices("ab.@-+% 0123459()é\n", k=random.randrange(40)))
        assert base_spans(text) == brute(text), text
    assert [k for k, *_ in base_spans("4111 1111-1111 1111 +1 (578) 555-6437 a@b.c 10.0.0.255 10.0.0.256")] == [0, 1, 2, 3]


def test_bootstrapping_and_odd_rows(spark):
    random.seed(1)
    docs = [(i, f"word{i % 7} please write mail to user{i}@host{i}.example.com for more text", None, None, 0) for i in range(30)]
    docs += [(100, "please write mail to someone(at)host9 for more", None, None, 0), (101, "the code x1y2z3 stays here", None, None, 0),
             (102, None, None, None, None), (None, "", None, None, None), (100, "please write mail to someone(at)host9 for more", None, None, 0)]
    df = spark.createDataFrame(docs, SCHEMA).selectExpr("*", "1 as kind", "2 as spans")
    out = digest(find_private(df)).collect()
    assert len(out) == len(docs)
    found = {r.doc_id: r for r in out}
    assert found[100].spans == "email:21:37" and found[100].n_email == 0 and found[100].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert found[101].spans == "" and found[102].spans == "" and found[None].spans == ""
    texts = {d[0]: d[1] for d in docs}
    for i in range(30):
        base = ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in sorted(brute(texts[i])))
        assert found[i].base_sha256 == hashlib.sha256(base.encode()).hexdigest() and found[i].spans == base and found[i].n_email == 1
    masked = redact(df)
    assert masked.columns == df.columns
    rows = {r.doc_id: r for r in masked.collect()}
    assert rows[100].text == "please write mail to [EMAIL] for more" and rows[100].n_chars == len(rows[100].text) and rows[102].text is None
    assert digest(find_private(df.limit(0))).count() == 0


def test_cues_with_unseen_identifiers(spark):
    def cue(first, lead, seeds, unseen, tail):
        texts = [f"{lead} {x}{tail}" for x in seeds + unseen]
        return [(first + i, t, None, None, 0) for i, t in enumerate(texts)], set(range(first + len(seeds), first + len(texts)))

    mails, phones = [f"user{i}@host{i}.example.com" for i in range(40)], [f"+49 {i} 5550{i:03}" for i in range(10, 40)]
    found, refused = [], []
    for (rows, ids), into in ((cue(0, "please write mail to", mails[:30], [f"u{i}(at)h{i}" for i in range(20)], " for more"), found),
                              (cue(100, "Phone:", phones[:12], [f"0049/{i}/55x" for i in range(10, 13)], ""), found),
                              (cue(200, "then ask", mails[30:35], [], ""), found),
                              (cue(300, "part number is", mails[:10], [f"A-{i}-77" for i in range(10, 40)], " in stock"), refused),
                              (cue(400, "seen near", mails[:9] + phones[12:16], [f"b9{i}zz" for i in range(10, 14)], " by us"), refused)):
        into.append((rows, ids))
    found[2][0].append((250, "then ask nobody9at9home", None, None, 0))
    found[2][1].add(250)
    docs = [r for rows, _ in found + refused for r in rows]
    out = {r.doc_id: r for r in digest(find_private(spark.createDataFrame(docs, SCHEMA))).collect()}
    assert len(out) == len(docs)
    for i, (_, ids) in enumerate(found):
        assert {k for k in ids if out[k].spans.startswith("phone:" if i == 1 else "email:")} == ids
    for _, ids in refused:
        assert {k for k in ids if out[k].spans} == set()
