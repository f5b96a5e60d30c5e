import hashlib
import random
import re
import time

from lexrev.llm.deobfuscate import _TABLE, find, mask, mask_text, odd_characters, personal_data

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    t = 0
    for i, c in enumerate(reversed(d)):
        v = int(c) * (1 + i % 2)
        t += v - 9 if v > 9 else v
    return t % 10 == 0


def brute(t):
    out = []
    for kind, p in PATTERNS.items():
        for m in re.finditer(p.replace("\\x20", " "), t):
            d = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(x) > 255 for x in m.group().split(".")):
                continue
            if kind == "card" and not (13 <= len(d) <= 19 and luhn(d)):
                continue
            if kind == "phone" and not 9 <= len(d) <= 15:
                continue
            out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def random_text(rng):
    pieces = ["a.b+c@d-e.f.g", "@", "a@b", "x@y.z@w.v", "1.2.3.4", "300.1.1.1", "1.2.3.4.5.6.7.8", "0001.2.3.004", "4111 1111 1111 1111",
              "4111-1111-1111-1111", "5500005555555559", "+1 (555) 123-4567", "+49 30 1234567", "+1", "+12345678901234567", " ", " ", "-", ".", "é", "日本",
              "7", "12", "_", "%", "\n", "word", "😀", "+", "(", "A"]
    return "".join(rng.choice(pieces) for _ in range(rng.randint(0, 14)))


def test_base_equals_the_patterns(spark):
    rng = random.Random(4)
    texts = [random_text(rng) for _ in range(1500)] + [None, ""]
    df = spark.createDataFrame([(i, t, 3) for i, t in enumerate(texts)], "doc_id long, text string, n_ip int")
    rows = {r.doc_id: r for r in personal_data(df).collect()}
    assert len(rows) == len(texts)
    for i, t in enumerate(texts):
        want = brute(t or "")
        r = rows[i]
        assert r.base == ",".join(want), t
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(w.startswith(k) for w in want) for k in PATTERNS)
        assert set(want) <= set(filter(None, r.spans.split(",")))


def added(t):
    _, more = find(t)
    return [t[a:b] for own in more for a, b in own]


def test_disguises_map_back_to_the_source():
    for t, want in {
        "write to john.doe [at] example [dot] com now": ["john.doe [at] example [dot] com"],
        "mail jane at mail dot example dot org today": ["jane at mail dot example dot org"],
        "bob(at)example.com!": ["bob(at)example.com"],
        "аnna@exаmple.com": ["аnna@exаmple.com"],
        "ｊｏｅ＠ｅｘａｍｐｌｅ．ｃｏｍ": ["ｊｏｅ＠ｅｘａｍｐｌｅ．ｃｏｍ"],
        "x joe​@exam​ple.com y": ["joe​@exam​ple.com"],
        "host 10 dot 0 dot 0 dot 1 up": ["10 dot 0 dot 0 dot 1"],
        "call plus four nine three zero one two three four five six seven please": ["plus four nine three zero one two three four five six seven"],
        "card four one one one 1111 1111 one one one one": ["four one one one 1111 1111 one one one one"],
        "１９２.168.0.1 é": ["１９２.168.0.1"],
        "we met at noon and the dot was one of two at home": [], "look at example.com for it": [], "at at dot at": [], "(at) [dot]": []}.items():
        assert added(t) == want, t


def test_base_spans_that_are_fragments_of_a_disguise():
    for t, want, masked in [
            ("to jоhn@example.com now", "jоhn@example.com", "to [EMAIL] now"),
            ("to john@mail.exаmple.com now", "john@mail.exаmple.com", "to [EMAIL] now"),
            ("call +49 170 123456 seven eight nine", "+49 170 123456 seven eight nine", "call [PHONE]"),
            ("a@b.cо.uk c@d.ef gо@x.yz", "a@b.cо.uk|gо@x.yz", "[EMAIL] [EMAIL] [EMAIL]")]:
        assert added(t) == want.split("|"), t
        assert mask_text(t) == masked
    assert added("fｕll john@example.com") == []


def test_runs_written_together_and_plain_at_signs():
    for t, want in {
            "call plus fourninethreezero onetwothreefour fivesixseven please": ["plus fourninethreezero onetwothreefour fivesixseven"],
            "call +49 170 123 six.": ["+49 170 123 six"], "+49 170 123 SIX, or not": ["+49 170 123 SIX"],
            "achtNULLfünf 1 2 3 4 5 6 7 8 9": [], "+1 555 1234 un un un": [],
            "to john@example [dot] com now": ["john@example [dot] com"], "to john@example dot com now": ["john@example dot com"],
            "to john@mail.example dot com now": ["john@mail.example dot com"], "see @example dot com": [],
            "a@b.de, x@y and dot . [dot] it": [], "money at phones seven, one@two dot": []}.items():
        assert added(t) == want, t
    assert mask_text("+49 170 123 six. john@example dot com") == "[PHONE]. [EMAIL]"


def test_masking(spark):
    t = "a b@c.de, +1 555 123 4567 and jo [at] ex [dot] org."
    assert mask_text(t) == "a [EMAIL], [PHONE] and [EMAIL]."
    df = spark.createDataFrame([(1, t, 9), (2, None, 9), (3, "clean", 5)], "doc_id long, text string, n_chars long")
    rows = {r.doc_id: (r.text, r.n_chars) for r in mask(df).collect()}
    assert rows == {1: (mask_text(t), len(mask_text(t))), 2: (None, None), 3: ("clean", 5)}


def test_long_texts_take_linear_time(spark):
    n = 200_000
    began = time.time()
    for t in ("a" * n, "1" * n, "1." * n, "a@" * n, "+1 " * n, " " * n, "[" * n, "one " * n, "( " * n, " at" * n, "x dot " * n, "é" * n, "a at " * n, "+ 1" * n):
        find(t)
    assert time.time() - began < 60
    assert personal_data(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_disguises_of_the_second_review():
    for t, want in {
            "john dot smith at example dot com": ["john dot smith at example dot com"],
            "to john [dot] smith [at] example [dot] com x": ["john [dot] smith [at] example [dot] com"],
            "john at example.com": [],
            "ip one nine two dot one six eight dot one dot one end": ["one nine two dot one six eight dot one dot one"],
            "192 dot one six eight dot 1 dot 1": ["192 dot one six eight dot 1 dot 1"],
            "+1 (four one five) five five five one two three four": ["+1 (four one five) five five five one two three four"],
            "\u0661\u0669\u0662.\u0661\u0666\u0668.\u0660.\u0661 x": ["\u0661\u0669\u0662.\u0661\u0666\u0668.\u0660.\u0661"],
            "a john at\nexample  dot\u2009com b": ["john at\nexample  dot\u2009com"],
            "juan arroba ejemplo punto com": ["juan arroba ejemplo punto com"], "jan arobase beispiel punkt de": ["jan arobase beispiel punkt de"],
            "0000010 dot 0 dot 0 dot 1": ["0000010 dot 0 dot 0 dot 1"], "jo     at     ex     dot     org": ["jo     at     ex     dot     org"],
            "one dot two dot three": [], "look at the point of it dot": [], "2999 dot 1 dot 1 dot 1": []}.items():
        assert added(t) == want, t
    assert mask_text("write john dot smith at example dot com now") == "write [EMAIL] now"


def disguised(rng):
    """A disguised identifier that each transducer has a part in, and its kind."""
    name, host, tld = (rng.choice(x) for x in (["john.doe", "anna", "m.k.lee", "info"], ["example", "mail-1", "corp"], ["com", "org", "de"]))
    words = ["zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine"]
    kind = rng.randrange(6)
    if kind == 0:
        return "email", f"{name}{rng.choice([' [at] ', '(at)', ' {at} ', ' <AT> '])}{host}{rng.choice([' [dot] ', '(dot)', '.'])}{tld}"
    if kind == 1:
        return "email", f"{name.replace('.', ' dot ')} {rng.choice(['at', 'arroba', 'arobase'])} {host} {rng.choice(['dot', 'punto', 'punkt'])} {tld}"
    if kind == 2:
        mail = f"{name}@{host}.{tld}"
        at = rng.randrange(len(mail))
        swap = {"a": "\u0430", "e": "\u0435", "o": "\u043e", "@": "\uff20", ".": "\uff0e"}
        return "email", "".join(swap.get(c, c) if i >= at else c for i, c in enumerate(mail[:-1])) + "\u200b" + mail[-1]
    if kind == 3:
        return "ip", " dot ".join(rng.choice([str(n), " ".join(words[int(c)] for c in str(n))]) for n in (rng.randrange(256) for _ in range(4)))
    if kind == 4:
        digits = [rng.choice(words) for _ in range(rng.randint(9, 12))]
        return "phone", f"{rng.choice(['plus', '+'])} {rng.choice([' ', '-']).join(digits)}"
    n = [rng.randrange(10) for _ in range(15)]
    total = sum(n[-2::-2]) + sum(sum(divmod(2 * d, 10)) for d in n[::-2])
    n.append(-total % 10)
    return "card", " ".join(words[d] if rng.random() < 0.7 else str(d) for d in n)


def test_recall_on_planted_disguises():
    rng = random.Random(11)
    filler = ["the report was sent", "we met there", "Nothing else.", "see below", "and so on"]
    found, kinds = 0, ("email", "ip", "card", "phone")
    for _ in range(600):
        kind, text = disguised(rng)
        before = rng.choice(filler) + ": "
        whole = before + text + rng.choice([", ", "; ", "\n"]) + rng.choice(filler)
        base, more = find(whole)
        found += any(a <= len(before) and b >= len(before) + len(text) for a, b in base[kinds.index(kind)] + more[kinds.index(kind)])
    assert found / 600 >= 0.95, found / 600


def test_null_ids_and_repeated_rows(spark):
    df = spark.createDataFrame([(None, "a@b.c"), (None, None), (3, "a@b.c"), (3, "a@b.c")], "doc_id long, text string")
    rows = sorted(map(str, personal_data(df).select("doc_id", "n_email", "spans").collect()))
    assert len(rows) == 4 and rows[0] == rows[1] and "email:0:5" in rows[0]


def test_odd_characters_are_found_in_time_linear_in_the_text():
    rng = random.Random(12)
    letters = "abc \u4e2d\u00e9\u1e9e" + "".join(chr(c) for c in rng.sample(sorted(_TABLE), 40))
    for _ in range(200):
        t = "".join(rng.choices(letters, k=rng.randint(0, 60)))
        assert odd_characters(t) == [(i, i + 1, _TABLE[ord(c)]) for i, c in enumerate(t) if ord(c) in _TABLE]
    plain = "une page d\u2019\u00e9t\u00e9, " * 200_000
    start = time.process_time()
    assert odd_characters(plain) == []
    assert time.process_time() - start < 1  # a class of the table's characters takes several seconds
