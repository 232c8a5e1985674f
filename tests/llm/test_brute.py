"""Pseudonyms, the language mixture and the ordinal fit against plain Python
loops that share no code with them but fixed values (patterns, constants)."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict
from datetime import date, timedelta

import numpy as np
import pytest

from sitelens.llm import langid, pii, toxicity

KEY = "a key of the test"

# -- pseudonyms ------------------------------------------------------------------


def feistel(label, a, p, b, q):
    for i in range(8):
        said = f"{KEY}|{label}|{i}|{b if i % 2 == 0 else a}"
        add = int(hashlib.sha256(said.encode()).hexdigest()[:15], 16)
        if i % 2 == 0:
            a = (a + add) % p
        else:
            b = (b + add) % q
    return a, b


def digits_of(text):
    return re.sub("[^0-9]", "", text)


def permuted(label, d):
    half = len(d) // 2
    a, b = feistel(f"{label}:{len(d)}", int(d[:half]), 10 ** half, int(d[half:]), 10 ** (len(d) - half))
    return str(a).zfill(half) + str(b).zfill(len(d) - half)


def refill(template, d):
    left = iter(d)
    return "".join(next(left) if "0" <= c <= "9" else c for c in template)


def luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        total += sum(divmod(int(c) * 2, 10)) if i % 2 == 0 else int(c)
    return str(-total % 10)


def rem97(text):
    return int("".join(str(int(c, 36)) for c in text)) % 97


def new_card(c):
    d = digits_of(c)
    if luhn(d[:-1]) == d[-1]:
        body = permuted("card", d[:-1])
        return refill(c, body + luhn(body))


def new_iban(c):
    plain = c.replace(" ", "")
    account, country, d = plain[4:], plain[:2], digits_of(plain[4:])
    if rem97(account + plain[:4]) == 1 and 2 <= len(d) <= 30:
        moved = refill(account, permuted("iban", d))
        return refill(c, str(98 - rem97(moved + country + "00")).zfill(2) + digits_of(moved))


def new_ssn(c):
    area, group, serial = map(int, c.split("-"))
    if 1 <= area <= 899 and area != 666 and group and serial:
        a, b = feistel("ssn", area - (2 if area > 666 else 1), 898, (group - 1) * 9999 + serial - 1, 99 * 9999)
        return f"{a + (2 if a >= 665 else 1):03}-{b // 9999 + 1:02}-{b % 9999 + 1:04}"


def new_phone(c):
    d = digits_of(c)
    if 7 <= len(d) <= 15:
        code = re.match(r"\+([0-9]{1,3})[ .(-]", c)
        kept = max(len(code.group(1)) if code else 0, len(d) - 10)
        if len(d) - kept >= 2:
            return refill(c, d[:kept] + permuted("phone", d[kept:]))


def new_ip(c):
    p = [int(x) for x in c.split(".")]
    if max(p) <= 255 and not re.search(r"(^|\.)0[0-9]", c):
        halves = feistel("ip", p[0] * 256 + p[1], 65536, p[2] * 256 + p[3], 65536)
        return ".".join(str(y) for h in halves for y in divmod(h, 256))


def new_date(c):
    x, y, z = map(int, re.split("[-./]", c))

    def real(y, m, d):
        try:
            return date(y, m, d)
        except ValueError:
            return None

    if "-" in c:
        day, form = real(x, y, z), "%Y-%m-%d"
    elif "." in c:
        day, form = real(z, y, x), "%d.%m.%Y"
    else:
        day, form = real(z, x, y), "%m/%d/%Y"
        if day is None:
            day, form = real(z, y, x), "%d/%m/%Y"
    if day and date(1901, 1, 1) <= day <= date(2099, 12, 31):
        n = (day - date(1901, 1, 1)).days
        a, b = feistel("date", n // 673, 108, n % 673, 673)
        return (date(1901, 1, 1) + timedelta(a * 673 + b)).strftime(form)


def new_email(c):
    return "u" + hashlib.sha256(f"{KEY}|email|{c.lower()}".encode()).hexdigest()[:16] + "@mail.invalid"


def account_in(c):
    if " " not in c:
        return c
    length = next((n for n, names in pii.LENGTHS.items() if c[:2] in names.split()), None)
    if length:
        tried = [length + (length - 1) // 4, len(c)]
    else:
        tried = [len(c), *[max(k, 3) * 5 - 1 for k in range((len(c) + 1) // 5, -1, -1)]]
    for k in tried:
        if k == len(c) or (k < len(c) and c[k] == " "):
            plain = c[:k].replace(" ", "")
            if rem97(plain[4:] + plain[:4]) == 1:
                return c[:k]


def told(c):
    """(characters, pseudonym) of a candidate, None where it is not valid."""
    if "@" in c:
        return len(c), new_email(c)
    kind = next(k for k in ("iban", "ip", "date", "ssn", "phone", "card") if re.fullmatch(pii.PATTERNS[k], c))
    if kind == "iban":
        c = account_in(c)
    if kind == "phone":
        shorter = re.sub("[ .-][0-9]{2,4}$", "", c)
        if len(digits_of(c)) > 15 and re.fullmatch(pii.PATTERNS["phone"], shorter):
            c = shorter
    new = c and globals()[f"new_{kind}"](c)
    return (len(c), new) if new else None


def plain_pseudonyms(text):
    out, at = [], 0
    for found in re.finditer(pii.BEGIN, text):
        if found.start() >= at and (value := told(found.group(1))):
            out += [text[at:found.start()], value[1]]
            at = found.start() + value[0]
    return "".join(out) + text[at:]


def iban(country, body):
    return country + str(98 - rem97(body + country + "00")).zfill(2) + body


def grouped(s, n=4):
    return " ".join(s[i:i + n] for i in range(0, len(s), n))


def some_text(rnd):
    num = lambda n: "".join(rnd.choice("0123456789") for _ in range(n))
    card = lambda n: (lambda b: b + luhn(b))(num(n - 1))
    made = [lambda: card(16), lambda: grouped(card(16)), lambda: grouped(card(16)).replace(" ", "-"), lambda: num(16), lambda: card(13),
            lambda: iban("DE", num(18)), lambda: grouped(iban("BE", num(12))), lambda: grouped(iban("GB", "WEST" + num(14))),
            lambda: grouped(iban("QQ", num(rnd.randint(11, 20)))), lambda: "DE" + num(20),
            lambda: f"{rnd.randint(0, 999):03}-{rnd.randint(0, 99):02}-{rnd.randint(0, 9999):04}",
            lambda: ".".join(str(rnd.randint(0, 300)) for _ in range(4)), lambda: "10.01.2.3", lambda: "1.2.3.4.5",
            lambda: f"{rnd.randint(1880, 2120)}-{rnd.randint(0, 13):02}-{rnd.randint(0, 32):02}",
            lambda: f"{rnd.randint(1, 31)}.{rnd.randint(1, 12)}.{rnd.randint(1890, 2110)}", lambda: f"{rnd.randint(1, 31)}/{rnd.randint(1, 31)}/2001",
            lambda: f"+{rnd.randint(1, 999)} {num(3)} {num(3)} {num(4)}", lambda: f"({num(3)}) {num(3)}-{num(4)}", lambda: f"{num(3)}-{num(3)}-{num(4)}",
            lambda: f"+44 {num(4)} {num(4)} {num(4)} {num(4)}", lambda: f"{rnd.choice('aBz')}.x{num(2)}@Mail-{num(1)}.example.org", lambda: "@no.mail",
            lambda: "AB12", lambda: num(rnd.randint(1, 24)), lambda: rnd.choice(["word", "É", "EUR", "日本", "x1", ""])]
    return "".join(rnd.choice(made)() + rnd.choice([" ", " ", ", ", "", "-", ".", "\n", "x", ": "]) for _ in range(rnd.randint(0, 14)))


def test_pseudonyms_text_by_text(spark):
    rnd = random.Random(21)
    texts = [some_text(rnd) for _ in range(3000)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id int, text string")
    got = {r["doc_id"]: r["text"] for r in pii.pseudonymise(docs, KEY).collect()}
    changed = 0
    for i, t in enumerate(texts):
        assert got[i] == plain_pseudonyms(t), t
        changed += got[i] != t
    assert changed > 2000


def test_pseudonyms_of_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    got = {r["doc_id"]: r["text"] for r in pii.pseudonymise(docs, KEY).collect()}
    assert got == {k: t and plain_pseudonyms(t) for k, t in texts.items()} and got != texts


def test_columns_of_clashing_names_stay(spark):
    from corpus_pipeline import pseudonyms
    docs = spark.createDataFrame([(1, "call +1 555 123 4567", "en", "s", 20, "own", "mine")],
                                 "doc_id long, text string, lang string, source string, n_chars long, __kinds string, __pii_found string")
    r = pseudonyms(spark, docs, "").first()
    assert (r["__kinds"], r["__pii_found"]) == ("own", "mine") and r["text"] != "call +1 555 123 4567"


# -- language mixture --------------------------------------------------------------


def plain_mixture(text, counts):
    """(language, shares) by loops over words, languages and sets."""
    langs = sorted({x for x, _, _ in counts})
    seen, context = defaultdict(Counter), defaultdict(Counter)
    for lang, gram, n in counts:
        seen[gram][lang] += n
        context[gram[:2]][lang] += n
    letters = len({g[2] for g in seen}) + 1

    def log_p(g, lang):
        if g[:2] not in context:
            return -math.log(letters)
        return math.log(seen[g][lang] + langid.ALPHA if g in seen else langid.ALPHA) - math.log(context[g[:2]][lang] + langid.ALPHA * letters)

    words = re.findall(r"[^\W\d_]+", text.lower())
    like = []
    for w in words:
        padded = "\x02\x02" + w + "\x03"
        logs = [sum(log_p(padded[i:i + 3], x) for i in range(len(padded) - 2)) for x in langs]
        like.append([math.exp(v - max(logs)) for v in logs])

    def em(share, rows, rounds):
        for _ in range(rounds):
            new = [0.0] * len(share)
            for row in rows:
                total = sum(p * s for p, s in zip(row, share))
                for i, (p, s) in enumerate(zip(row, share)):
                    new[i] += p * s / total / len(rows)
            share = new
        return share, sum(math.log(sum(p * s for p, s in zip(row, share))) for row in rows)

    full, _ = em([1 / len(langs)] * len(langs), like, langid.ROUNDS)
    order = sorted(range(len(langs)), key=lambda i: -full[i])
    best, chosen = -math.inf, {}
    for m in range(1, len(langs) + 1):
        some = order[:m]
        first = [full[i] / sum(full[j] for j in some) for i in some]
        share, log = em(first, [[row[i] for i in some] for row in like], langid.FEWER if m > 1 else 0)
        gain = log - 0.5 * (m - 1) * math.log(len(words))
        if gain > best + 1e-9:
            best, chosen = gain, {langs[i]: s for i, s in zip(some, share)}
    return max(chosen, key=chosen.get), chosen


def test_mixture_and_set_by_loops(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    counts = langid.fit(docs, sample=150)
    rows = [r["text"] for r in docs.filter("lang IS NOT NULL AND length(text) BETWEEN 20 AND 600").orderBy("doc_id").limit(60).collect()]
    rows = [t for t in rows if re.search(r"[^\W\d_]", t)]
    rows += [a + " " + b for a, b in zip(rows[::2], rows[1::2])]
    several = 0
    for text, (lang, _, shares, fits) in zip(rows, langid.predict(rows, langid.Model(counts)), strict=True):
        want, chosen = plain_mixture(text, counts)
        assert lang == want and fits
        assert dict(shares) == pytest.approx({k: v for k, v in chosen.items() if v > 0}, abs=1e-6)
        several += len(chosen) > 1
    assert several > 5


# -- ordinal regression --------------------------------------------------------------


def ordinal_loss(w, theta, rows, grade, ridge, weight):
    total = 0.0
    for (ids, x), g, part in zip(rows, grade, weight):
        s = sum(w[i] * v for i, v in zip(ids, x))
        above = [1.0, *[1 / (1 + math.exp(t - s)) for t in theta], 0.0]
        total -= part * math.log(max(above[g] - above[g + 1], 1e-12))
    return total / sum(weight) + 0.5 * ridge * sum(v * v for v in w)


def test_ordinal_fit_is_at_the_least_loss():
    """No small step of any weight or threshold lowers the loss, and the
    numeric gradient there is near zero."""
    rnd = np.random.default_rng(6)
    rows = [([int(i) for i in rnd.choice(5, rnd.integers(0, 4), replace=False)], None) for _ in range(150)]
    rows = [(ids, [float(v) for v in rnd.uniform(0.5, 2, len(ids))]) for ids, _ in rows]
    true = np.array([2.0, 1.0, -1.0, 0.5, 0.0])
    grade = [int(np.searchsorted([0.5, 1.5, 3.0], sum(true[i] * v for i, v in zip(ids, x)) + rnd.logistic())) for ids, x in rows]
    weight = [float(v) for v in rnd.integers(1, 4, 150)]
    ridge = 1e-2
    w, theta = toxicity.fit_ordinal([i for i, _ in rows], [x for _, x in rows], np.array(grade), 5, weight=np.array(weight), ridge=ridge)
    loss = lambda p: ordinal_loss(p[:5], p[5:], rows, grade, ridge, weight)
    at = np.concatenate([w, theta])
    for i in range(len(at)):
        step = np.zeros(len(at))
        step[i] = 1e-4
        assert abs(loss(at + step) - loss(at - step)) / 2e-4 < 2e-3
        for size in (0.05, -0.05):
            moved = at.copy()
            moved[i] += size
            if (np.diff(moved[5:]) > 0).all():
                assert loss(moved) > loss(at) - 1e-6
