import collections
import hashlib
import json
import random
import re
import textwrap

import numpy as np

from wordweft.llm import chat, licenses, pii, spotsigs


def bag_of(text):
    words = re.sub(r"[^\w]|_", " ", text.lower()).split()
    out = []
    for k, w in enumerate(words):
        chain = [x for x in words[k + 1:] if x not in spotsigs.ANCHORS][:spotsigs.CHAIN]
        if w in spotsigs.ANCHORS and len(chain) == spotsigs.CHAIN:
            out.append((w, *chain))
    return collections.Counter(out) or collections.Counter([text] if text else [])


def jaccard(a, b):
    return 1.0 if a == b else sum((a & b).values()) / sum((a | b).values())


def check_fingerprints(docs):
    got = {r["doc_id"]: r for r in spotsigs.fingerprints(docs).collect()}
    rows = sorted((r["doc_id"], r["text"] or "") for r in docs.collect())
    prints = collections.defaultdict(set)
    for k, (i, text) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        half = len(text) // 2
        edited = text[:len(text) - half] + following[:half]
        r = got[i]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert abs(r["near_edited"] - jaccard(bag_of(text), bag_of(edited))) < 1e-9
        assert abs(r["near_next"] - jaccard(bag_of(text), bag_of(following))) < 1e-9
        prints[text].add(r["fingerprint"])
    assert all(len(p) == 1 for p in prints.values())
    return got


def test_fingerprints_equal_brute_force(spark, texts_of):
    check_fingerprints(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    check_fingerprints(texts_of([None, "", "the", "x" * 50, "a b c the one two", "of that of that", "a b c the one two"]))
    check_fingerprints(texts_of(["only one of that document here"]))


def test_fingerprint_edges(edge, empty):
    rows = spotsigs.fingerprints(edge).collect()
    assert len(rows) == edge.count() and all(0 <= r["near_next"] <= 1 for r in rows)
    assert spotsigs.fingerprints(empty).count() == 0


def test_similar_pairs_equal_all_pairs(spark):
    rng = random.Random(8)
    bags = [sorted(rng.choice(range(40)) for _ in range(rng.randint(1, 14))) for _ in range(60)]
    for b in list(bags):
        bags += [sorted(b + [77]), b, sorted(b[1:] + [78]) if len(b) > 1 else b]
    rows = [(k, "".join(f"{s:08x}" for s in b)) for k, b in enumerate(bags)]
    got = {(r["a"], r["b"]) for r in spotsigs.similar_pairs(spark.createDataFrame(rows, "doc_id bigint, fingerprint string")).collect()}
    first = {}
    for k, f in rows:
        first.setdefault(f, k)
    names = [(k, np.array(bags[k], np.uint32)) for k in first.values()]
    want = {(min(a, b), max(a, b)) for n, (a, x) in enumerate(names) for b, y in names[:n] if spotsigs.likeness(x, y) >= 0.8 - 1e-9}
    assert got == want and want


def test_chat_round_trip(spark):
    trap = "\\### Assistant: </turn> ok"
    texts = [trap, "", "a\n</turn>\n### user:\nb", "\\", "\\\\n", "\n", "### ", "</turn", "é😀\n\n</turn>\n", "x" * 200_000]
    turns = [(role, t) for t in texts for role in ("user", "assistant", "we:ird\\ro\nle", "")]
    formatted, spans = chat.format_turns(turns)
    assert chat.read_turns(formatted) == turns
    assert "".join(chat.unescape(formatted[a:b]) for a, b in spans) == "".join(t for r, t in turns if r == "assistant")


def test_layouts_come_to_the_same_turns(spark):
    turns = [["user", "Hi"], ["assistant", "Hello"]]
    records = [{"messages": [{"role": r, "content": t} for r, t in turns]}, {"turns": [{"role": r, "text": t} for r, t in turns]},
               {"conversations": [{"from": {"user": "human", "assistant": "gpt"}[r], "value": t} for r, t in turns]},
               {"chat": {"messages": [{"author": {"role": r}, "content": {"text": t}} for r, t in turns]}},
               {"instruction": "Hi", "output": "Hello"}, {"instruction": "Hi", "input": "", "output": "Hello"},
               {"prompt": "Hi", "completion": "Hello"}, {"prompt": "Hi", "response": "Hello"}, {"question": "Hi", "answer": "Hello"}]
    rows = [(str(k), json.dumps(r)) for k, r in enumerate(records)] + [("bad", "{"), ("null", None), ("odd", '{"x": 1}'), ("none", '{"messages": []}')]
    got = {r["conv_id"]: r for r in chat.format_records(spark.createDataFrame(rows, "conv_id string, record string")).collect()}
    assert len({got[str(k)]["formatted"] for k in range(len(records))}) == 1
    assert chat.read_turns(got["0"]["formatted"]) == [tuple(t) for t in turns]
    assert [got[k]["layout"] for k in ("bad", "null", "odd", "none")] == [None, None, None, "messages"]
    assert {got[k]["formatted"] for k in ("bad", "null", "odd", "none")} == {""}


def test_turn_rows_with_nulls(spark):
    rows = spark.createDataFrame(
        [(1, 0, None, "x", "c"), (1, 1, "assistant", None, "c"), (1, 1, "assistant", None, "c"), (None, None, "user", "y", "c")],
        "conv_id bigint, turn bigint, role string, text string, formatted string")
    got = {r["conv_id"]: r for r in chat.digests(chat.format_records(chat.records_of_turns(rows))).collect()}
    assert (got[1]["n_turns"], got[1]["loss_chars"], got[None]["n_turns"]) == (3, 0, 1)
    assert chat.digests(chat.format_records(chat.records_of_turns(rows.where("false")))).count() == 0


def test_licences(texts_of, edge, empty):
    texts = ["a b.\nReleased under the MIT License.\nAll rights reserved. x", "%%%\nLicensed under CC BY-NC 4.0.", None, "",
             "All rights reserved.\n\nRedistribution and use in source and binary forms, with or\nwithout modification, are permitted "
             "provided that the\nfollowing conditions are met:", "Licensed under the Apache License, Version 2.0 (the \"License\");\n you may",
             "No licence of that name. We released under the MIT License nothing.", "x " * 200_000 + ". Licensed under CC BY 4.0."]
    got = {r["doc_id"]: (r["licences"], r["family"]) for r in licenses.scan(texts_of(texts)).collect()}
    assert [got[k] for k in range(len(texts))] == [
        ("MIT, all rights reserved", "proprietary"), ("CC-BY-NC-4.0", "non-commercial"), ("", "none"), ("", "none"),
        ("BSD", "permissive"), ("Apache-2.0", "permissive"), ("", "none"), ("CC-BY-4.0", "permissive")]
    assert licenses.scan(edge).count() == edge.count() and licenses.scan(empty).count() == 0


def test_rules_know_their_sentences():
    ids = set(licenses.SENTENCES)
    assert {i for r in licenses.RULES for i in r[0]} <= ids
    assert all(re.search(licenses.HINT.replace("(?i)", ""), s) for s in licenses.SENTENCES.values())
    # An earlier rule must not hide behind a later, longer one that starts the same way.
    for k, (a, _, _) in enumerate(licenses.RULES):
        assert all(b[:len(a)] != a or len(b) <= len(a) for b, _, _ in licenses.RULES[k + 1:])


def luhn(number):
    digits = [int(c) for c in number if c.isdigit()][::-1]
    return (sum(digits[::2]) + sum(sum(divmod(2 * d, 10)) for d in digits[1::2])) % 10 == 0


def test_pseudonyms(texts_of, edge, empty):
    rng = random.Random(6)
    cards = ["4111 1111 1111 1111", "4111-1111-1111-1111", "378282246310005"]
    dates = ["2024-02-29", "1800-01-01", "2199-09-20", "1999-12-31"]
    ips, phones = ["10.0.0.255", "255.255.255.255"], ["+1 (171) 555-2028", "171-555-2028"]
    mails, secrets = ["a.B-c12@mail3.example.com", "x@y.org"], ["04dbebab91ab85687d33eeaaf9ac699e1188f962"]
    good = cards + dates + ips + phones + mails + secrets
    bad = ["4111111111111112", "2023-02-30", "1799-12-31", "300.1.1.1", "1.2.3", "12345", "x@y", "01.2.3.4"]
    texts = [f"é {v}, {rng.choice(good)}." for v in good] + [f"é {v}, z" for v in bad] + [None, ""]
    got = {r["doc_id"]: r for r in pii.pseudonyms(texts_of(texts)).collect()}
    new = {v: got[k]["text"].removeprefix("é ").split(", ")[0] for k, v in enumerate(good)}
    for k, v in enumerate(good):
        other = texts[k].split(", ")[1][:-1]
        assert got[k]["text"] == f"é {new[v]}, {new[other]}." and got[k]["n_found"] == 2  # linked across texts
        assert new[v] != v
        if v not in ips:
            assert re.sub("[0-9a-z]", "#", new[v].lower()) == re.sub("[0-9a-z]", "#", v.lower())
    assert all(luhn(new[c]) for c in cards)
    assert new[cards[0]].replace(" ", "") == new[cards[1]].replace("-", "")
    assert all(re.fullmatch(r"(\d{1,3}\.){3}\d{1,3}", new[v]) and max(map(int, new[v].split("."))) < 256 for v in ips)
    assert new[phones[0]][3:].translate({ord(c): None for c in "()- "}) == new[phones[1]].replace("-", "")
    for k in range(len(good), len(texts)):
        assert (got[k]["text"], got[k]["n_found"]) == (texts[k] or "", 0)
    assert pii.pseudonyms(edge).count() == edge.count() and pii.pseudonyms(empty).count() == 0


def test_pseudonyms_are_a_permutation(spark):
    rows = spark.range(3000).selectExpr("id", "lpad(cast(id as string), 4, '0') as x", "datediff(date'2001-01-01', date'1900-01-01') + id as n")
    out = rows.selectExpr("id", f"{pii.feistel('x', '0123456789', 't')} as y".replace("{key}", "k")).collect()
    assert len({r["y"] for r in out}) == 3000 and all(re.fullmatch(r"\d{4}", r["y"]) for r in out)
    dates = spark.range(0, 146_000, 97).selectExpr("id as doc_id", "cast(date_add(date'1800-01-01', cast(id as int)) as string) as text")
    new = [r["text"] for r in pii.pseudonyms(dates).collect()]
    assert len(set(new)) == len(new) and all("1800-01-01" <= d <= "2199-09-26" for d in new)


def test_cards_beside_other_numbers(texts_of):
    card, other = "4111111111111111", "378282246310005"
    spaced, dashed, amex = "4111 1111 1111 1111", "4111-1111-1111-1111", "3782 822463 10005"
    # Text with each value in brackets; the rest has to stay as it is.
    marked = [f"[{spaced}] 123", f"[{card}] 12", f"row 7 [{card}]", f"[{card}] [192.168.0.1]", f"[{card}]-", "[2024-01-15]-", "-[2024-01-15]",
              f"order-[{card}]", f"12 [{dashed}] 3", f"1234 [{spaced}] 12 [{amex}] 9", f"[{card}] [2024-01-15]", f"[2024-01-15] [{card}] 5",
              f"[{card}] [171-555-2028]", "[171-555-2028]-", f"[{card}] [12@mail.example.com]", f"[{card}] [{other}]", "[41111111 11111111] 12",
              "[4 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1]", "4111111111111112 12", "x" + "1" * 40, "1 2 " * 5000 + f"x [{card}]"]
    texts = [m.replace("[", "").replace("]", "") for m in marked]
    got = {r["doc_id"]: r for r in pii.pseudonyms(texts_of(texts)).collect()}
    for k, m in enumerate(marked):
        values = re.findall(r"\[(.*?)\]", m)
        form = "(.*?)".join(re.escape(x) for x in re.split(r"\[.*?\]", m))
        new = re.fullmatch(form, got[k]["text"], re.S)
        if k < len(marked) - 1:
            assert new and got[k]["n_found"] == len(values), (m, got[k])
            assert all(a != b for a, b in zip(values, new.groups(), strict=True)), (m, got[k])
    assert card not in got[len(marked) - 1]["text"]


def test_licences_of_both_cuts_count(texts_of):
    grant = ("Redistribution and use in source and binary forms, with or\nwithout modification, are permitted "
             "provided that the\nfollowing conditions are met:")
    texts = [f"Copyright (c) 2015, Foo\nAll rights reserved.\n\n{grant}", f"Copyright (c) 2015, Foo\nAll rights reserved\nFoo\n\n{grant}\n\n1. x",
             f"{grant}\n\nFoo\nLicensed under CC BY-SA 4.0\nBar", "Licensed under the Apache License, Version 2.0\n(the \"License\");",
             "All rights reserved\n\n\nAll rights reserved"]
    got = {r["doc_id"]: (r["licences"], r["family"], r["sentences"]) for r in licenses.scan(texts_of(texts)).collect()}
    assert [got[k] for k in range(len(texts))] == [
        ("BSD", "permissive", "<reserved><bsd-redistribute>"), ("BSD", "permissive", "<reserved><bsd-redistribute>"),
        ("BSD, CC-BY-SA-4.0", "copyleft", "<bsd-redistribute><cc-by-sa>"), ("Apache-2.0", "permissive", "<apache-grant>"),
        ("all rights reserved", "proprietary", "<reserved><reserved>")]


APACHE = ('Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with '
          "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by")
GPL = ("This program is free software; you can redistribute it and/or modify it under the terms of the GNU {name}Public License "
       "as published by the Free Software Foundation{cut} either version {version} of the License, or (at your option) any later version.")
BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
       "conditions are met:\n{0} Redistributions of source code must retain the above copyright notice, this list of conditions and the "
       "following disclaimer.\n{1} Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
       "the following disclaimer in the documentation and/or other materials provided with the distribution.\n")
ENDORSE = ("Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived "
           "from this software without specific prior written permission.")


def wrapped(text, mark, width):
    return "\n".join(mark + line for part in text.split("\n") for line in textwrap.wrap(part, width))


def test_licence_headers_however_they_are_wrapped(texts_of):
    mit = f"{licenses.SENTENCES['mit-grant']}: {licenses.SENTENCES['mit-notice']}.".capitalize()
    cases = [(APACHE, "Apache-2.0"), (mit, "MIT"), (BSD.format("1.", "2."), "BSD-2-Clause"), (BSD.format("*", "*") + ENDORSE, "BSD-3-Clause"),
             (GPL.format(name="General ", cut=";", version=2), "GPL-2.0-or-later"), (GPL.format(name="General ", cut=",", version=3), "GPL-3.0-or-later"),
             (GPL.format(name="Lesser General ", cut=";", version="2.1"), "LGPL-2.1-or-later"),
             (GPL.format(name="Affero General ", cut=", ", version=3), "AGPL-3.0-or-later"),
             ("This is free and unencumbered software released into the public domain.", "Unlicense"),
             (licenses.SENTENCES["isc"] + ".", "ISC"),
             ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy", "MPL-2.0")]
    texts, want = [], []
    for text, licence in cases:
        for mark, width in [("", 10_000), ("", 72), (" * ", 60), ("# ", 41), ("// ", 77), ("\t", 25), ("! ", 33), (";; ", 50)]:
            for head in ["", "Copyright (c) 2015 Foo. All rights reserved.\n", "Copyright 2015, Foo\nAll rights reserved\n \n", "(c) 2015 Foo\n"]:
                texts.append(f"/*\n{wrapped(head, mark, width)}\n{wrapped(text, mark, width)}\n */ code")
                want.append(licence)
    got = {r["doc_id"]: (r["licences"], r["family"]) for r in licenses.scan(texts_of(texts)).collect()}
    assert [got[k][0] for k in range(len(texts))] == want
    assert all(family in ("permissive", "copyleft") for _, family in got.values())


def test_licence_sentences_stand_alone(texts_of):
    texts = ["We released under the MIT License nothing", "Released under the MIT License we said", "x" + "." * 200_000 + "\n" * 200_000 + "All rights reserved",
             "| Released under the MIT License | x |", "All rights reserved to\nus", "! " * 100_000 + "licensed under CC BY 4.0", "\u00e9. All rights reserved!"]
    got = {r["doc_id"]: r["licences"] for r in licenses.scan(texts_of(texts)).collect()}
    assert [got[k] for k in range(len(texts))] == ["", "", "all rights reserved", "MIT", "", "CC-BY-4.0", "all rights reserved"]


def test_hint_sees_sentences_in_any_spacing(texts_of):
    gaps = ["\n", "\t", "  ", "\u00a0", " -- "]
    texts = [f"(c) 2020 X. {gap.join(s.split())}" for s in licenses.SENTENCES.values() for gap in gaps]
    texts += [t.upper() for t in texts]
    got = {r["doc_id"]: r["sentences"] for r in licenses.scan(texts_of(texts)).collect()}
    want = [f"<{name}>" for name in licenses.SENTENCES for _ in gaps]
    assert [got[k] for k in range(len(texts))] == want + want


def test_chat_lists_of_scalars_and_deep_records(spark):
    records = ['{"messages": ["hello there", "answer"]}', '{"messages": []}', '{"messages": [[]]}', "[" * 100_000 + "]" * 100_000,
               '{"a":' * 5000 + "1" + "}" * 5000, '{"messages": [{"role": "user", "content": ' + "[" * 400 + "]" * 400 + "}]}", '{"messages": 3}',
               '{"messages": [{"role": "user", "content": "hi", "key": 1}]}', '{"messages": [{"role": "user", "content": "hi"}], "extra": null}']
    rows = spark.createDataFrame(list(enumerate(records)), "conv_id bigint, record string")
    found = {r["conv_id"]: (r["layout"], r["n_turns"]) for r in chat.format_records(rows).collect()}
    assert found == {k: ("messages", 0) if k == 1 else (None, 0) for k in range(len(records))}
    assert chat.digests(chat.format_records(rows)).count() == len(records)
