"""The operators' kernels against brute force; no Spark."""

import random
import re
import time

import numpy as np
import pytest

from cartolink.llm import brown, decontaminate, fingerprint, fuzzy_lines, html_text, pii, quality, secrets
from cartolink.llm.automaton import compile_rules
from cartolink.llm.meeting import group_links, sketches
from cartolink.llm.partenum import Plan
from cartolink.llm.shingles import shingle_set
from cartolink.llm.tagger import Reader, Tagger


def ends(dfa, data):
    row, out = dfa.rows[0], []
    for at, b in enumerate(data, 1):
        row = row[b]
        if row[256]:
            out.append(at)
    return out


@pytest.mark.parametrize("pattern", ["a(b|cd)*e?", "[a-c]{2,3}x", "(?i:ab)+|d{2}", "a.c", r"\d+\.\d", "[^a]b"])
def test_automaton_agrees_with_re(pattern):
    rng, dfa = random.Random(pattern), compile_rules([pattern])
    for _ in range(500):
        s = "".join(rng.choice("abcdeABx.1") for _ in range(rng.randint(0, 7)))
        assert [n for n in ends(dfa, s.encode())] == [n for n in range(1, len(s) + 1) if re.fullmatch(pattern, s[:n])]


def test_automaton_is_minimal():
    assert len(compile_rules(["(a|b)*abb"]).accepts) == 4 + 1  # and the state of no return
    assert len(compile_rules(["ab|cb|db"]).accepts) == len(compile_rules(["[acd]b"]).accepts)


ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def base_secrets(t):
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    return sorted(out + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24])


def test_secrets_agree_with_patterns():
    rng, scan = random.Random(1), secrets.scanner()
    parts = ["token", "Secret", "=", ":", " ", '"', "abc", "abcdef0", "AKIA", "AKIAX", "0123456789abcdef", "é", ".", "password", "api_key", "ABC123DEF456G", "\n"]
    for _ in range(5000):
        t = "".join(rng.choice(parts) for _ in range(rng.randint(1, 14)))
        assert [s for s in scan.spans(t) if s[1] < secrets.BASE] == base_secrets(t), t


def test_secrets_add_known_formats():
    t = "é ghp_" + "a1B2" * 9 + " and -----BEGIN RSA PRIVATE KEY-----"
    assert [secrets.RULES[k].kind for _, k, _ in secrets.scanner().spans(t)] == ["github", "private_key"]


PATTERNS = [
    (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
    (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
    (r"[0-9]([\x20-]?[0-9])+", lambda s: 13 <= len(d := re.sub("[ -]", "", s)) <= 19 and pii.luhn(d)),
    (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(re.findall("[0-9]", s)) <= 15),
]


def test_personal_data_patterns():
    rng = random.Random(2)
    parts = ["a.b", "@", "x.com", ".", "-", "1", "255", "300", ".", " ", "+1", "(555)", "4111111111111111", "4111 1111-1111 1111", "00", "é", "@@", "a@b.c-"]
    for _ in range(5000):
        t = "".join(rng.choice(parts) for _ in range(rng.randint(1, 12)))
        expected = [(k, m.start(), m.end()) for k, (p, ok) in enumerate(PATTERNS) for m in re.finditer(p, t) if ok(m[0])]
        assert pii.base_spans(t) == expected, t


def test_tagger_gradient():
    tagger = Tagger(5, hidden=3)
    x, y = pii.labelled(4, steps=7)
    _, grad = tagger.loss(x, y)
    for k, p in tagger.p.items():
        at = np.unravel_index(np.abs(grad[k]).argmax(), p.shape)
        held = p[at]
        p[at] = held + 1e-5
        up = tagger.loss(x, y)[0]
        p[at] = held - 1e-5
        down = tagger.loss(x, y)[0]
        p[at] = held
        assert grad[k][at] == pytest.approx((up - down) / 2e-5, rel=1e-3)


def test_tagger_learns_and_windows_join():
    reader = pii.trained()
    x, y = pii.labelled(200, seed=77)
    texts = ["".join(map(chr, x[:, k])) for k in range(x.shape[1])]
    got = reader.spans(reader.emissions([x[:, k] for k in range(x.shape[1])]))
    tags = np.zeros_like(y)
    for k, spans in enumerate(got):
        for a, b, tag, _ in spans:
            tags[a:b, k] = tag
    assert (tags == y).mean() > 0.95 and texts
    # A span that lies across a window's end is found as it is in a window's middle.
    found = []
    for place in (20, Reader.CORE // 2 - 3):
        before = "a " * place
        text = before + "x john.smith@mail.example.org y " + "b " * 200
        spans = reader.spans(reader.emissions([pii.codes(text)]))[0]
        found.append([(a - len(before), b - len(before), tag) for a, b, tag, _ in spans])
    assert found[0] == found[1] and any(a < 20 < b and tag == 1 for a, b, tag in found[0])


def whole_path(e, move):
    """The best tags of one text: every place decoded, no tag before and after."""
    score, back = e[:, 0] + move[0], []
    for k in range(1, e.shape[1]):
        every = score[:, None] + move
        back.append(every.argmax(0))
        score = every.max(0) + e[:, k]
    path = [int((score + move[:, 0]).argmax())]
    for b in reversed(back):
        path.append(int(b[path[-1]]))
    return path[::-1]


@pytest.mark.parametrize("level", [0.0, 1.0, 2.5])
def test_decoding_between_gaps_is_decoding_all(level):
    rng = np.random.default_rng(int(level * 10))
    reader = Tagger(5).ready()
    crossed = 0
    for _ in range(60):
        reader.move = rng.normal(0, 1.2, (5, 5)).astype(np.float32) + np.float32(rng.uniform(0, 2)) * np.eye(5, dtype=np.float32)
        e = rng.normal(0, 1, (5, 400)).astype(np.float32)
        e[0] += level * rng.uniform(0.5, 2)
        for at in rng.integers(0, 380, 4):  # stretches that speak for a tag, or hardly against one
            e[rng.integers(1, 5), at : at + rng.integers(3, 90)] += level * rng.uniform(0.5, 2)
        path = whole_path(e.astype(float), reader.move.astype(float))
        for gap in (6, 48):
            got = [0] * 400
            for a, b, tag, _ in reader.spans([e], gap)[0]:
                got[a:b] = [tag] * (b - a)
            assert got == path
        crossed += any(path)
    assert crossed > 10


def test_tagger_adds_forms_beyond_the_patterns():
    """Precision and recall of added spans on labelled text that the tagger has not seen."""
    writer, made = pii._Writer(99), []
    for _ in range(600):
        text, true = "", []
        for _ in range(40):
            kind = int(writer.rng.integers(4)) if writer.rng.random() < 0.06 else None
            piece = writer.filler() if kind is None else (writer.email, writer.ip, writer.card, writer.phone)[kind]()
            if kind is not None:
                true.append((kind, len(text), len(text) + len(piece)))
            text += piece + writer.pick([" "] * 8 + ["\n", ". ", ", ", " | "])
        made.append((text, true))
    odd, added, right = 0, 0, 0
    for (_, true), (base, every) in zip(made, pii.all_spans([t for t, _ in made], pii.trained()), strict=True):
        beyond = {s for s in true if all(e <= s[1] or s[2] <= b for _, b, e in base)}
        new = set(every) - set(base)
        odd, added, right = odd + len(beyond), added + len(new), right + len(new & set(true))
    assert odd > 400 and right / added > 0.97 and right / odd > 0.85


def test_fingerprints_estimate_generalised_jaccard():
    rng = random.Random(3)
    sampler, off = fingerprint.Sampler(samples=256), []
    for k in range(40):  # words of its own in each trial, as equal words draw equal numbers
        a = fingerprint.bag_of(" ".join(f"{c}{k}" for c in rng.choices("abcdefghij", k=60)))
        b = fingerprint.bag_of(" ".join(f"{c}{k}" for c in rng.choices("defghijklm", k=40)))
        true = sum((a & b).values()) / sum((a | b).values())
        off.append(fingerprint.likeness(*sampler.fingerprints([a, b])) - true)
    assert abs(np.mean(off)) < 0.02 and np.abs(off).max() < 0.15
    assert sampler.fingerprints([a]) == fingerprint.Sampler(samples=256).fingerprints([b, a])[1:]
    assert fingerprint.likeness("", "") == 1.0 and fingerprint.likeness("", "ab") == 0.0


PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style></head><body class="has-sidebar"><nav><a href=x>menu</a></nav>
<div class="ad">buy</div><div id="content"><h1>Head  line</h1><p>One &amp; two<b> three</b><p>Four<br>five<ul><li>six<li>seven</ul></div>
<div class="comments"><p>reader says a lot of things here that are long enough to look like text</p></div><footer>&copy; x</footer></body>"""


def test_html():
    assert html_text.main_text(PAGE) == "Head line\nOne & two three\nFour five\nsix\nseven"
    assert html_text.main_text(PAGE.replace('<div id="content">', "<article>").replace("</ul></div>", "</ul></article>")) == html_text.main_text(PAGE)


@pytest.mark.parametrize("source, text", [(None, ""), ("", ""), ("plain", "plain"), ("<p>a", "a"), ("<script>x", ""), ("<p", ""), ("a < b", "a < b"), ('<p title="a>b">c', "c"), ("<!-- x", "")])
def test_html_odd(source, text):
    assert html_text.main_text(source) == text


def test_html_takes_cousins():
    # Two rows of columns: neither holds the other's paragraphs, nor does one column's siblings.
    rows = [[f"{chr(97 + row)}{k} " + "word " * 60 for k in range(n)] for row, n in enumerate((6, 5))]
    row = lambda texts: '<div class="row"><div class="col">' + "".join(f"<p>{t}</p>" for t in texts) + "</div></div>"
    page = "<body>" + "<div>" + row(rows[0]) + row(rows[1]) + "</div></body>"
    assert html_text.main_text(page).split("\n") == [t.strip() for t in rows[0] + rows[1]]
    menu = '<div class="row"><div>' + "".join(f'<a href="/{k}">go {k}</a>' for k in range(30)) + "</div></div>"
    assert html_text.main_text(page.replace("</div></body>", menu + "</div></body>")).split("\n") == [t.strip() for t in rows[0] + rows[1]]


def test_html_deep():
    assert html_text.main_text("<div>" * 20_000 + "x") == "x"


def test_html_takes_time_in_proportion():
    seconds = []
    for n in (3_000, 12_000):
        for page in ("<b>" * n + "<p>x" * n, "<i><div>" + "<b>" * n + "x</i>" * n):
            began = time.process_time()
            assert html_text.main_text(page).replace("\n", "") == "x" * n
            seconds.append(time.process_time() - began)
    assert seconds[2] < 12 * seconds[0] + 0.5 and seconds[3] < 12 * seconds[1] + 0.5


def test_tiling_of_repetitive_texts():
    rng = random.Random(9)
    for _ in range(40):  # two or three different words
        item = np.array([rng.choice([1, 1, 1, 2]) for _ in range(30)], np.uint64)
        text = np.array([rng.choice([1, 1, 1, 2, 3]) for _ in range(120)], np.uint64)
        many, decontaminate.MANY = decontaminate.MANY, 0
        at_once = decontaminate.tiles(item, text, 3)
        decontaminate.MANY = 10**9
        assert at_once == decontaminate.tiles(item, text, 3)
        decontaminate.MANY = many
    began = time.process_time()
    assert sum(n for *_, n in decontaminate.tiles(np.ones(200, np.uint64), np.ones(20_000, np.uint64), 5)) == 200
    assert time.process_time() - began < 2


def brute_tiles(item, text, least):
    p, d, out = [False] * len(item), [False] * len(text), 0
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for j in range(len(text)):
                n = 0
                while i + n < len(item) and j + n < len(text) and item[i + n] == text[j + n] and not p[i + n] and not d[j + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < least:
            return out
        for k in range(n):
            p[i + k] = d[j + k] = True
        out += n


def test_tiling_covers_moved_parts():
    rng = random.Random(4)
    for _ in range(60):
        item = [rng.choice("abcdefgh") + str(k) * rng.randint(0, 1) for k in range(24)]
        parts = [item[:8], item[8:16], item[16:]]
        rng.shuffle(parts)
        text = ["z"] * 5 + parts[0] + ["y"] + parts[1] + parts[2] + ["w"]
        h = lambda ws: np.array([hash(w) & 0xFFFFFFFF for w in ws], np.uint64)
        got = decontaminate.tiles(h(item), h(text), 3)
        assert sum(n for *_, n in got) == brute_tiles(item, text, 3)
        for i, j, n in got:
            assert item[i : i + n] == text[j : j + n]


def test_decontamination_block():
    items = [(1, "one two three four five six seven eight nine ten"), (2, "alpha beta gamma"), (3, "")]
    block = decontaminate._block([(i, decontaminate.tokens(t)) for i, t in items if t])
    find = lambda t: [(block.ids[k], c) for k, c, _ in decontaminate.matches(block, decontaminate.tokens(t), 0.6)]
    assert find("x SIX, seven eight nine ten! y one two three four five z") == [(1, 10)]
    assert find("one two three four five and no more") == []
    assert find("say alpha beta gamma") == [(2, 3)]
    assert find("alpha beta") == [] and find("") == []


def test_partenum_shares_a_signature():
    rng, plan = np.random.default_rng(5), Plan(85, 100)
    for _ in range(400):
        n = int(rng.integers(1, 300))
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        keep = rng.random(len(a)) > rng.random() * 0.2
        b = np.unique(np.concatenate([a[keep], rng.integers(0, 2**63, int(rng.integers(0, n // 8 + 1))).astype(np.uint64)]))
        inter = len(np.intersect1d(a, b))
        linked = len(a) and len(b) and 100 * inter >= 85 * (len(a) + len(b) - inter)
        assert plan.linked(a, b) == bool(linked)
        if linked and not np.array_equal(a, b):
            assert len(np.intersect1d(plan.signatures(a), plan.signatures(b)))
        if len(a) and len(b):
            x, y = sketches([a, b])
            assert np.bitwise_count(x ^ y).sum() <= len(a) + len(b) - 2 * inter


@pytest.mark.parametrize("cross", [False, True])
def test_group_links_connect_all_that_link(cross):
    rng = np.random.default_rng(7)
    for trial in range(60):
        base = np.unique(rng.integers(0, 2**63, int(rng.integers(5, 200))).astype(np.uint64))
        sets = [np.unique(np.append(base[rng.random(len(base)) > rng.random() * 0.25], rng.integers(0, 2**63, 1).astype(np.uint64))) for _ in range(int(rng.integers(2, 40)))]
        label = rng.integers(0, len(sets), len(sets)).astype(np.int64)
        side = rng.integers(0, 2, len(sets)) if cross else None
        want, got = {int(x): int(x) for x in label}, {int(x): int(x) for x in label}

        def find(up, x):
            while up[x] != x:
                x = up[x]
            return x

        def join(up, i, j):
            a, b = sorted((find(up, int(label[i])), find(up, int(label[j]))))
            up[b] = a

        linked = lambda i, j: 100 * (both := len(np.intersect1d(sets[i], sets[j]))) >= 80 * (len(sets[i]) + len(sets[j]) - both)
        for i in range(len(sets)):
            for j in range(i):
                if (side is None or side[i] != side[j]) and linked(i, j):
                    join(want, i, j)
        pairs = group_links(sets, label, 80, 100, int(rng.integers(0, len(sets))), side)
        assert len(pairs) < len(sets) and all(linked(i, j) for i, j in pairs)
        for i, j in pairs:
            join(got, i, j)
        assert [find(got, int(x)) for x in label] == [find(want, int(x)) for x in label]


def test_shingle_sets():
    assert len(shingle_set("A b c D e", 4)) == 2 and np.array_equal(shingle_set("A B", 4), shingle_set("a  b", 4))
    assert len(shingle_set("", 4)) == len(shingle_set(None, 4)) == len(shingle_set(" \n", 4)) == 0
    assert len(shingle_set("a a a a a a", 4)) == 1


def test_bands_find_similar_lines():
    rng, found = random.Random(6), 0
    lines, pairs = [], []
    for _ in range(200):
        line = "".join(rng.choice("abcdefgh ") for _ in range(120)).strip()
        at = rng.randint(20, 100)
        lines += [line, line[:at] + "Z" + line[at + 1 :]]
    keys = fuzzy_lines.bands(lines)
    pairs = [len(set(keys[k]) & set(keys[k + 1])) for k in range(0, 400, 2)]
    found = sum(p > 0 for p in pairs)
    assert found >= 196
    assert sum(len(set(keys[k]) & set(keys[k + 2])) > 0 for k in range(0, 398, 2)) == 0
    assert np.array_equal(fuzzy_lines.bands(["ab", lines[0]])[1], keys[0])


def test_exchange_separates_words():
    # Words 0-3 follow words 4-7 and the other way round.
    grid = np.zeros((9, 9))
    rng = np.random.default_rng(8)  # with even counts no single move betters the start
    grid[:4, 4:8] = rng.integers(1, 20, (4, 4))
    grid[4:8, :4] = rng.integers(1, 20, (4, 4))
    of = brown.exchange(grid, 8, 2, 5)
    assert len(set(of[:4])) == 1 and len(set(of[4:8])) == 1 and of[0] != of[4]


def test_quality_learns_from_positives_and_unlabelled():
    rng = random.Random(7)
    good = [" ".join("".join(rng.choice("aeilnorst") for _ in range(rng.randint(2, 8))) for _ in range(60)) + "." for _ in range(300)]
    junk = [g.upper().replace(" ", "!! ") for g in good[200:]]
    pos = np.stack([quality.features(t) for t in good[:100]])
    web = np.stack([quality.features(t) for t in good[100:200] + junk[:50]])
    model = quality.fit(pos, web, prior=2 / 3)
    score = lambda ts: model.score(np.stack([quality.features(t) for t in ts]))
    assert (score(good[200:]) > 0.5).mean() > 0.95 and (score(junk[50:]) < 0.3).mean() > 0.95
    assert 0 <= score([""])[0] <= 1 and 0 <= score([None])[0] <= 1
    assert quality.fit(pos[:0], web, 0.5).score(web).tolist() == [0.5] * len(web)


@pytest.mark.parametrize("share", [0.2, 0.6, 0.9, 1.0])
def test_quality_estimates_the_prior(share):
    rng = random.Random(3)
    prose = lambda: " ".join("".join(rng.choice("aeilnorst") for _ in range(rng.randint(2, 8))) for _ in range(40)) + "."
    pos = np.stack([quality.features(prose()) for _ in range(400)])
    web = [prose() if rng.random() < share else prose().upper().replace(" ", "!! ") for _ in range(800)]
    true = sum(t.islower() for t in web) / len(web)
    found = quality.class_prior(pos, np.stack([quality.features(t) for t in web]))
    assert abs(found - true) < 0.08
    assert quality.class_prior(pos[:1], pos) == quality.class_prior(pos, pos[:0]) == 0.5


def test_quality_risk_falls_along_the_gradient():
    """The fitted risk, computed a second way, is near the least that small moves of its weights find."""
    rng = np.random.default_rng(4)
    pos, web = rng.normal(0.6, 1, (200, quality.FEATURES)), rng.normal(0, 1, (300, quality.FEATURES))
    pos[:, 5:], web[:, 5:] = 0, 0
    model = quality.fit(pos, web, 0.4, steps=2000, decay=0.0)
    loss = lambda z: np.log1p(np.exp(-z))

    def risk(weights, bias):
        a, u = (np.clip((x - model.mean) / model.scale, -8, 8) @ weights + bias for x in (pos, web))
        return 0.4 * loss(a).mean() + max(0.0, loss(-u).mean() - 0.4 * loss(-a).mean())

    least = risk(model.weights, model.bias)
    for _ in range(50):
        move = rng.normal(0, 0.1, quality.FEATURES)
        assert risk(model.weights + move, model.bias + float(rng.normal(0, 0.1))) > least - 1e-4
