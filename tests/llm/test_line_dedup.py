import re
from collections import Counter, defaultdict

from series_engine.llm import line_dedup
from tests.llm.helpers import AWKWARD, clash, docs


BLANK = re.compile(r"[\x20\x09-\x0d]+")


def split(line):
    return [x for x in BLANK.split(line) if x]


def near(a, b, similarity=0.5):
    """Two texts share enough without their longest common line."""
    def parts(t):
        found = {}
        for line in t.split("\n"):
            w = split(line)
            if w:
                found[line] = {tuple(w[i:i + 3]) for i in range(len(w))}
        return found
    x, y = parts(a), parts(b)
    p, q = set().union(*x.values()), set().union(*y.values())
    longest = max((len(x[k]) for k in x.keys() & y.keys()), default=0)
    both, either = len(p & q) - longest, len(p | q) - longest
    return both > 0 and both >= similarity * either


def brute(texts, min_docs, depth=3, share=0.25, min_long=3, long_words=20):
    """The operator's rules over all pairs of texts: ``(text, line number)`` dropped."""
    parsed = {}
    for t in {x for x in texts if x is not None}:
        for i, line in enumerate(t.split("\n")):
            if split(line):
                parsed[t, i] = tuple("<*>" if re.search("[0-9@]", x) else x for x in split(line))
    leaf = lambda f: (len(f), f[:depth])
    leaf_texts, form_texts = defaultdict(set), defaultdict(set)
    for (t, _), f in parsed.items():
        leaf_texts[leaf(f)].add(t)
        form_texts[f].add(t)
    forms = {f: len(s) for f, s in form_texts.items() if len(leaf_texts[leaf(f)]) >= min_docs}
    cell = Counter()
    for f, n in forms.items():
        for p, x in enumerate(f):
            cell[leaf(f), p, x] += n
    fine = lambda f, p, x: x != "<*>" and cell[leaf(f), p, x] >= max(min_docs, share * len(leaf_texts[leaf(f)]))
    units = defaultdict(set)  # forms of a template or of a line as it is, with the families it needs
    for f in forms:
        kept = tuple(x if fine(f, p, x) else "<*>" for p, x in enumerate(f))
        same, agreed = sum(x != "<*>" for x in kept), sum(x != "<*>" for x in kept[depth:])
        if 2 * same >= len(f) and 2 * agreed >= sum(x != "<*>" for x in f[depth:]):
            units["template", leaf(f), kept, min_docs].add(f)
    for f, s in form_texts.items():
        least = min_long if len(f) >= long_words else min_docs
        if len(s) >= least and 2 * sum(x != "<*>" for x in f) >= len(f):
            units["line", f, None, least].add(f)
    units = {u: fs for u, fs in units.items() if u[0] == "line" or sum(forms[f] for f in fs) >= min_docs}
    holders = {u: set().union(*(form_texts[f] for f in fs)) for u, fs in units.items()}
    nodes = sorted(set().union(*holders.values())) if holders else []
    root = {t: t for t in nodes}

    def top(t):
        while root[t] != t:
            t = root[t]
        return t
    for i, x in enumerate(nodes):
        for y in nodes[:i]:
            if top(x) != top(y) and near(x, y):
                root[top(x)] = top(y)
    drop = {f for u, fs in units.items() if len({top(t) for t in holders[u]}) >= u[3] for f in fs}
    return {k for k, f in parsed.items() if f in drop}


def test_equal_brute_force(spark):
    rows = list(AWKWARD)
    for i in range(12):
        rows.append((100 + i, f"own line number words {'abcdefghijkl'[i]}\nPage {i} of 20\nshared   footer line\n\nlast {i}x {i}y", "en", "s", 0))
        rows.append((200 + i, f"visit us at shop{'xyz'[i % 3]} today please\nunique{i} words{i * 7} only{i}\nthe cat sat on {'abcdefghijkl'[i]} mat", "en", "s", 0))
    rows += [(300, "lonely copy line here", "en", "s", 0)] * 9
    got = line_dedup.line_dedup(clash(docs(spark, rows), "_k1", "_k2", "_t", "_drop", "row", "kept", "n_lines", "n_dropped"), min_docs=4).collect()
    texts = [r[1] for r in rows]
    drop = brute(texts, 4)
    assert len(drop) > 20

    def rest(t):
        return t if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if (t, i) not in drop)
    want = Counter((r[0], rest(r[1])) for r in rows)
    assert Counter((r.doc_id, r.text) for r in got) == want
    by = {r.doc_id: r for r in got}
    assert by[300].n_dropped == 0  # copies of one text are one document
    assert by[1].text is None and by[1].n_lines == 0 and by[100].n_dropped > 0
    assert set(got[0].asDict()) >= {"doc_id", "text", "lang", "source", "n_chars", "_k1", "_k2", "_t", "_drop", "row", "kept"}


def test_empty(spark):
    assert line_dedup.line_dedup(docs(spark, [])).count() == 0


def near_copies(n, lines, tag, edits=3):
    """A text of ``lines`` lines of 30 words, ``n`` times with a few words changed."""
    out = []
    for i in range(n):
        w = [[f"{tag}{'abcdefghij'[k % 10]}{'klmnopqrst'[k // 10 % 10]}{'uvwxyz'[j]}" for k in range(30)] for j in range(lines)]
        for e in range(edits):
            w[(i + e) % lines][29] = f"edit{'abcdefghijklmnopqrstuvwxyz'[i % 26]}{'xyz'[e]}{'pq'[i // 26]}"
        out.append("\n".join(" ".join(x) for x in w))
    return out


def test_a_family_of_near_copies_is_one_witness(spark):
    """Its lines stay, in every member, and a footer of independent texts goes."""
    family = near_copies(30, 4, "fam")
    apart = [f"{near_copies(1, 1, f'own{a}', 0)[0]}\nshared footer of the site" for a in "abcdefghijkl"]
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(family + apart)]
    got = {r.doc_id: r for r in line_dedup.line_dedup(docs(spark, rows)).collect()}
    assert max(Counter(x for t in family for x in t.split("\n")).values()) > 3  # as texts they would vouch for long lines
    assert {t for t, _ in brute(family + apart, 10)} == set(apart)
    assert all(got[i].text == t and got[i].n_dropped == 0 for i, t in enumerate(family))
    assert all(got[i].n_dropped == 1 and "footer" not in got[i].text for i in range(30, 42))


def test_unique_lines_with_a_common_opening_stay(spark):
    """The leading tokens that a leaf fixes are no evidence, and rows of one list are one text."""
    lines = [f"I think that {a}one {a}two {a}three" for a in "abcdefghijkl"]
    # common words in a large leaf: 'the' and 'of' in a fifth of its lines
    lines += [f"we all know {'the' if i % 5 == 0 else f'w{chr(97 + i % 26)}{chr(97 + i // 26)}'} x{chr(97 + i % 26)}{chr(97 + i // 26)} "
              f"{'of' if i % 5 == 0 else f'y{chr(97 + i % 26)}{chr(97 + i // 26)}'}" for i in range(60)]
    rows = [(i, f"own{chr(97 + i % 26)}{chr(97 + i // 26)} text of its own\n{x}", "en", "s", 0) for i, x in enumerate(lines)]
    rows.append((500, "\n".join(f"red apples from {x}land for all of us" for x in "abcdefghij"), "en", "s", 0))
    rows += [(600 + i, f"red apples from {x}a {x}b {x}c {x}d {x}e", "en", "s", 0) for i, x in enumerate("klmnopqrs")]
    got = line_dedup.line_dedup(docs(spark, rows)).collect()
    want = {r[0]: r[1] for r in rows}
    assert {r.doc_id: r.text for r in got if r.doc_id < 500} == {k: v for k, v in want.items() if k < 500}
    assert {r.doc_id: r.text for r in got if r.doc_id >= 500} == {k: v for k, v in want.items() if k >= 500}


def test_clashing_names_in_the_stage(spark):
    import corpus_pipeline
    names = ("_t", "_k1", "_k2", "_drop", "n_lines", "n_dropped", "row", "kept", "c0")
    df = clash(docs(spark, [(i, f"own words of text {i} and no more\nthe very same footer line of all", "en", "s", 1) for i in range(12)] + AWKWARD), *names)
    out = corpus_pipeline.drop_lines(spark, df, "")
    assert out.columns == df.columns and out.count() == df.count()
    assert {tuple(r) for r in out.select(*names).distinct().collect()} == {("x",) * len(names)}


def apart(tag, n):
    """A line of ``n`` words that no other text has."""
    return " ".join(f"{tag}{'abcdefghij'[i // 10 % 10]}{'klmnopqrst'[i % 10]}" for i in range(n))


def test_a_footer_does_not_vouch_for_its_own_holders(spark):
    """Short independent texts that a footer makes alike are no family."""
    footer = apart("foot", 20)
    for own in (60, 4):
        texts = [f"{apart('own' + 'abcdefghij'[i % 10] + 'xy'[i // 10], own)}\n{footer}" for i in range(20)]
        got = line_dedup.line_dedup(docs(spark, [(i, t, "en", "s", 0) for i, t in enumerate(texts)])).collect()
        assert sorted(r.text for r in got) == sorted(t.split("\n")[0] for t in texts)
        assert len(brute(texts, 10)) == 20


def test_long_lines_of_few_texts(spark):
    """A line of 80 words in 9 different texts goes, in 2 it stays, in a family it stays."""
    rows = [(i, f"{apart(f'own{chr(97 + i)}', 40)}\n{apart('nine', 80)}", "en", "s", 0) for i in range(9)]
    rows += [(20 + i, f"{apart(f'pair{chr(97 + i)}', 40)}\n{apart('two', 80)}", "en", "s", 0) for i in range(2)]
    rows += [(30 + i, f"{apart('kin', 60)} {chr(97 + i)}\n{apart('held', 80)}", "en", "s", 0) for i in range(8)]
    got = {r.doc_id: r for r in line_dedup.line_dedup(docs(spark, rows)).collect()}
    assert [got[i].n_dropped for i in range(9)] == [1] * 9
    assert all(got[i].n_dropped == 0 for i in got if i >= 20)
    assert {t for t, _ in brute([r[1] for r in rows], 10)} == {r[1] for r in rows[:9]}


def test_tables_equal_brute_force(spark):
    """Whole table: families by buckets give what all pairs give."""
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = [r.text for r in df.collect()]
    drop = brute(texts, 10)
    want = Counter(t and "\n".join(x for i, x in enumerate(t.split("\n")) if (t, i) not in drop) for t in texts)
    assert Counter(r.text for r in line_dedup.line_dedup(df).collect()) == want


def test_a_text_is_hashed_once_not_for_every_line(spark):
    from series_engine.llm.line_dedup import parsed
    docs = spark.createDataFrame([(1, "a b c\nd e f")], "doc_id long, text string")
    plan = parsed(docs, "text", 3)._jdf.queryExecution().optimizedPlan().toString()
    above = plan.split("Generate", 1)[0]
    assert "_line" in above and "xxhash64(_t#" not in above and "xxhash64(1, _t#" not in above


def test_a_line_is_split_without_a_pattern(spark):
    from series_engine.llm.line_dedup import parsed
    docs = spark.createDataFrame([(1, "a b c\nd e f")], "doc_id long, text string")
    above = parsed(docs, "text", 3)._jdf.queryExecution().optimizedPlan().toString().split("Generate", 1)[0]
    assert "split(" in above and "\\x20\\x09-\\x0D]+" not in above and above.count("RLIKE") == 1


def test_lines_with_tabs_and_carriage_returns(spark):
    """Other blanks part words like spaces, and a line of them alone is none."""
    texts = [f"own{c} words{c} of{c}\r\n\t shared\tfooter \x0b line{' ' * (i + 1)}of all\r\n \t\r\n\x0c\nlast {c}{c}" for i, c in enumerate("abcdefghijkl")]
    texts += [f"{apart('far' + c, 30)}\tx\n{apart('far' + c, 9)}" for c in "abc"]
    got = line_dedup.line_dedup(docs(spark, [(i, t, "en", "s", 0) for i, t in enumerate(texts)])).collect()
    drop = brute(texts, 10)
    assert len(drop) >= 12
    for r in got:
        t = texts[r.doc_id]
        assert r.text == "\n".join(x for i, x in enumerate(t.split("\n")) if (t, i) not in drop)
        assert r.n_lines == sum(bool(split(x)) for x in t.split("\n"))
