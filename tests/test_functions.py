"""Column expressions on hand-made values."""

import ast
import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from vacantia.functions import html, rules, salary, similarity, skills, text, vocab

NBSP = " "


def test_list_sizes():
    assert len(vocab.NOISE_TITLES) == 36 and len(vocab.DOMAIN_WORDS) == 32
    assert sum(len(w) for _, w in vocab.ROLE_KEYWORDS) == 99 and len(vocab.ROLE_KEYWORDS) == 8
    assert len(vocab.ROLE_PATTERNS) == 20 and len(vocab.LOCATION_PATTERNS) == 32
    assert len(set(vocab.SKILLS_FULL)) == 118 and len(set(vocab.SKILLS_SHORT)) == 51


def test_strip_takes_no_break_space(apply):
    assert apply(text.strip, [f"{NBSP} a b\t", "", None, f"{NBSP}"]) == ["a b", "", None, ""]


def test_strip_takes_all_white_space_at_the_ends(apply):
    spaces = [chr(i) for i in range(0x10000) if chr(i).isspace() and not 0x1C <= i <= 0x1F]
    assert apply(text.strip, [f"{s}{s}a{s}b{s}\n" for s in spaces]) == [f"a{s}b" for s in spaces]
    assert apply(text.strip, ["\x1ca\u200b", "\n\r\n"]) == ["\x1ca\u200b", ""]


def test_sentinels(apply):
    assert apply(text.fill_sentinel, [None, "", "x"]) == [vocab.NOT_STATED, vocab.NOT_STATED, "x"]
    assert apply(text.replace_value, [vocab.NOT_STATED, "Bali", None]) == ["DKI Jakarta", "Bali", None]


def test_to_number(apply):
    assert apply(text.to_number, ["5", " 1.5 ", "x", "", None, "nan", "1e6"]) == [5.0, 1.5, None, None, None, None, 1e6]


def test_to_time(apply):
    got = apply(lambda c: text.to_time(c).cast("string"), ["2026-04-21T16:42:40.123456", "soon", None, "2026-04-21"])
    assert got == ["2026-04-21 16:42:40.123456", None, None, "2026-04-21 00:00:00"]


def test_clip(apply):
    assert apply(text.clip, [5e5, 2e6, 2e8, None], "double") == [1e6, 2e6, 1e8, None]


@pytest.mark.parametrize("raw, want", [
    ("['a', 'b']", ["a", "b"]), ('["a", "it\'s"]', ["a", "it's"]), (r"['it\'s']", ["it's"]), ("[]", []), ("", []),
    ("nan", []), (None, []), ("['a', ", []), ("oops", []), ("['c++', 'react native']", ["c++", "react native"]),
])
def test_parse_list(apply, raw, want):
    assert apply(text.parse_list, [raw]) == [want]


LITERALS = [
    "['python', None, 'sql']", "('a','b')", "['a',]", "['a']", "('a')", "('a',)", "()", "[]", "[,]", "['a',,]", "['a' 'b', 'c']", "[1, -2, +3, 0, 1_000]",
    "[1.5, .5, 2., 1e3]", "[True, False, None]", "['a', ['b']]", "['a', x]", "'a', 'b'", "  ['a'] \n", "[\n 'a' ,\n\t'b'\n]", "['a", "['a'] 'b'", "['a\nb']",
    r"['a\nb\t\\', '\'', '\x41\u00e9\101\U0001F600', '\d']", r"[r'a\nb', u'c']", r"['\x4']", r"['\u12']", "{'a': 1}", "['a\\\nb']", "['it\"s', \"it's\"]",
    "['', \"\"]", "[007]", "['a'", "'a']", "None", "5", "['[x]', '(y', ',']", "['日本', 'é😀']", "[1 2]", "['a' 1]", "[__import__('os')]"]


@pytest.mark.parametrize("raw", LITERALS)
def test_parse_list_as_a_literal(apply, raw):
    """As the interpreter reads it; what is no flat list or tuple is empty."""
    try:
        value = ast.literal_eval(raw)
    except (ValueError, SyntaxError):
        value = []
    flat = isinstance(value, (list, tuple)) and all(x is None or isinstance(x, (str, bool, int, float)) for x in value)
    assert apply(text.parse_list, [raw]) == [[None if x is None else str(x) for x in value] if flat else []]


def test_plain_lists_are_read_without_tokens(apply):
    """Short cut and full reading agree; what is nearly plain takes the full one."""
    raws = ["[]", "['']", "['a','b', 'c d']", "['é', '\"']", "['a' 'b']", "['a',  'b']", "['a',]", "['a\\'b']", "['a\nb']", "['a']\n", "['a'"]
    full = [[], [""], ["a", "b", "c d"], ["é", '"'], ["ab"], ["a", "b"], ["a"], ["a'b"], [], ["a"], []]
    assert apply(text.parse_list, raws) == full
    assert apply(lambda c: c.rlike(text.PLAIN_LIST), raws) == [True] * 4 + [False] * 7
    assert apply(lambda c: text.parse_list(text.format_list(c)), [["it's", "a\\b", None, "c"], []], "array<string>") == [["it's", "a\\b", "c"], []]


def test_starting_letters_change_no_match(apply):
    assert rules.starting("bandung|bekasi|kl\\b") == "(?=[bk])(?:bandung|bekasi|kl\\b)"
    for kept in (r"\bmid\b|medior", "c[to]o", "a?b|c", "b*", "", "a|", "(x|y)z"):
        assert rules.starting(kept) == kept
    got = apply(lambda c: rules.classify_patterns(c, [("x", r"ab+|cd"), ("y", r"b\s*c")], "-"), ["zABB", "b c", "c", None, "xcd"])
    assert got == ["x", "y", "-", "-", "x"]


def test_parse_list_of_many_items(apply):
    items = [f"it's {i}" for i in range(5000)]
    assert apply(text.parse_list, [repr(items)]) == [items]


def test_parse_list_lenient(apply):
    assert apply(text.parse_list_lenient, ["['a', \"b\"]", "a, ,b", "[]", None, "['react native']"]) == [
        ["a", "b"], ["a", "b"], [], [], ["react native"]]


def test_list_round_trip(spark):
    value = ["a", "it's", "b\\c", 'd"e']
    df = spark.createDataFrame([(value,), ([],)], "v array<string>")
    back = df.select(text.parse_list(text.format_list(F.col("v")))).collect()
    assert [r[0] for r in back] == [value, []]


def test_city_and_work_type(apply):
    places = ["Jakarta Selatan, DKI Jakarta (Hybrid)", " Bandung ", "", None, "Bogor (Remote)", "Bogor (On-site)"]
    assert apply(text.city, places) == ["Jakarta Selatan", "Bandung", "", None, "Bogor (Remote)", "Bogor (On-site)"]
    assert apply(text.work_type, places) == ["Hybrid", "Unknown", "Unknown", "Unknown", "Remote", "On-site"]


def test_strip_html(apply):
    page = "<p>a<br>b</p><script>x<y;</script><style>p{}</style><!-- <b>no</b> --> <i>c</i>&amp;"
    assert apply(text.strip_html, [page, None, "plain"]) == ["a b c &amp;", None, "plain"]


def test_urls(apply):
    raw = ["/id/job/1?x=1", "https://a.b/c?d#e", "ftp://x", "", None]
    assert apply(lambda c: text.canonical_url(c, "https://h"), raw) == ["https://h/id/job/1", "https://a.b/c", "", "", ""]
    assert apply(text.url_id, ["https://x/jobs/view/123/?a", "https://x/jobs/12", None]) == ["123", "", ""]


def test_identity_key(spark):
    df = spark.createDataFrame([("1", "u"), ("", "u"), (None, ""), ("", None)], "id string, url string")
    assert [r[0] for r in df.select(text.identity_key(F.col("id"), F.col("url"))).collect()] == ["1", "u", None, None]


def test_page_fields(apply):
    pages = ["<h3> </h3><h1>One <b>two</b></h1>", "<h4>x</h4>", "<h3>first</h3><h1>second</h1>"]
    assert apply(lambda c: text.first_match(c, [r"(?s)<h3>(.*?)</h3>", r"(?s)<h1>(.*?)</h1>"]), pages) == [
        "One two", "", "first"]
    assert apply(lambda c: text.join_matches(c, r"<a>(.*?)</a>"), ["<a>Jakarta</a><a> </a><a>Bandung</a>", ""]) == [
        "Jakarta, Bandung", ""]


def test_longest_text(apply):
    a, b = "a" * 51, "b" * 60
    pages = [f"<div>{a}</div><div>{b}</div><div>{'c' * 60}</div>", f"<div>{'a' * 50}</div><p>{'x' * 60}</p><p>{'y' * 40}</p>",
             f"<div>{'a' * 50}</div><p>{'x' * 60}</p><p>{'y' * 39}</p>", None]
    assert apply(lambda c: html.longest_text(c, ["div"], "p"), pages) == [b, "x" * 60 + "\n" + "y" * 40, "", ""]


def test_nested_elements(apply):
    pages = ["<div><div>short</div>long text</div>", "<div id=a>x<br>y<div class='k jd z'>in<p>one<p>two</div>z", "<ul><li>a<ul><li>b</ul><li>c</ul>",
             "</div>stray<div>open <b>bold</div>after</b>", "<table><tr><td>1<td>2<tr><td><table><tr><td>in</table>out</table>",
             "<DIV>a<img src='x'>b<hr/><!-- <div>no</div> --><script>'<div>no'</script></DIV>", "no tags < at all", "", None]
    wanted = [[["short long text", "short"], []], [["x y in one two z", "in one two"], []], [[], []], [["open bold"], []],
              [[], ["1", "2", "in out", "in"]], [["a b"], []], [[], []], [[], []], [[], []]]
    assert apply(lambda c: html.texts(c, ["div", "td"]), pages) == wanted
    assert apply(lambda c: html.texts(c, ["li"]), [pages[2]]) == [[["a b", "b", "c"]]]


@pytest.mark.parametrize("selector, want", [
    ('[data-x="1"]', ["one"]), ("div", ["one", "two deep", "deep"]), ("#it", ["two deep"]), (".big", ["deep"]), ("div.small.big", ["deep"]),
    ('div[id*="t"]', ["two deep"]), ("section div", ["two deep", "deep"]), ("section div:not([id])", ["deep"]), ("span, div.big", ["deep", "three"]),
    ("#it div", ["deep"]), ("div section", []), ("[data-x]", ["one", "three"]), ('[data-x="2"]', []), (".bi", []), ("*.big", ["deep"])])
def test_selectors(apply, selector, want):
    page = ('<div data-x="1">one</div><section><div id="it">two <div class=\'small big\'>deep</div></div></section>'
            '<span data-x=3 title="a > b">three</span>'.replace(' title="a > b"', ""))
    assert apply(lambda c: html.texts(c, [selector]), [page]) == [[want]]


def test_selectors_are_tried_in_order(apply):
    long = "w" * 60
    page = f'<div class="outer"><div id="jobDescription">{long}</div><p>{"x" * 120}</p></div>'
    assert apply(lambda c: html.longest_text(c, ['[data-a="none"]', "#jobDescription", ".outer"], "p"), [page]) == [long]
    assert apply(lambda c: html.longest_text(c, ["h2", "h3"], "p"), [page]) == ["x" * 120]
    assert apply(lambda c: html.first_text(c, ["h1", "p", "div"]), [page, "<h1> </h1><p></p><div>d</div>", "<h1></h1><h1>second</h1>"]) == ["x" * 120, "d", "second"]
    with pytest.raises(ValueError):
        html.texts(F.lit(""), ["div > p"])


def test_many_elements_of_a_long_page(apply):
    page = "<div>" * 300 + "deep" + "</div>" * 300 + "".join(f"<p>{i}" for i in range(700))
    got = apply(lambda c: html.texts(c, ["div", "p"]), [page])[0]
    assert got[0] == ["deep"] * 300 and got[1] == [str(i) for i in range(700)]


def test_role_by_keyword(apply):
    titles = ["AI Engineer", "AI Specialist", "Analytics Engineer", "Full-Stack Dev", "Maintenance Trainee",
              "Senior DATA Scientist", "", None]
    assert apply(rules.role_by_keyword, titles) == [
        "ML Engineer", None, "Data Analyst", "Fullstack Developer", None, "Data Scientist", None, None]
    assert apply(lambda c: rules.role_by_keyword(c, lower_rules=True), ["AI Specialist"]) == ["ML Engineer"]


def test_role_by_pattern(apply):
    terms = ["data  engineer", "Front-End Dev", "react native", "IT Support", "cloud", "PM", "npm tools", "clerk", " ", None,
             f"data{NBSP}science", "qa engineer", "devops"]
    assert apply(rules.role_by_pattern, terms) == [
        "Data Engineer", "Frontend Developer", "Mobile Developer", "IT Support", "Cloud Engineer", "Product Manager",
        "Product Manager", "Other", "Other", "Other", "Data Scientist", "QA Engineer", "DevOps Engineer"]


def test_place(apply):
    raw = ["Jakarta Barat", "Yogyakarta", "Sleman", "Kepulauan Riau", "Batam", "", None, vocab.NOT_STATED, "Tokyo",
           "Alam Sutera", "NTT", "Remote", "KL", "Klaten"]
    assert apply(rules.place, raw) == [
        "DKI Jakarta", "Jawa Tengah", "D.I. Yogyakarta", "Riau", "Kepulauan Riau", vocab.NOT_STATED, vocab.NOT_STATED,
        vocab.NOT_STATED, "Lainnya", "Banten", "NTT", "Remote / WFH", "Malaysia", "Jawa Tengah"]


def test_three_seniority_rules_differ(apply):
    titles = ["Lead Engineer", "Staff Accountant", "International Sales", "Head of Data", "Engineer", "Sr. Dev", "Jr Dev"]
    assert apply(rules.seniority, titles) == [
        "Senior", "Senior", "Intern", "Manager/Head", "Mid-level", "Senior", "Mid-level"]
    assert apply(rules.title_seniority, titles + [None]) == [
        "Manager/Head", "Mid-level", "Junior", "Manager/Head", vocab.NOT_STATED, "Senior", "Junior", vocab.NOT_STATED]
    assert apply(lambda c: rules.level_from_text(c, F.lit("")), titles + ["CTO", "mid developer", "Entry-level"]) == [
        "Senior", vocab.NOT_STATED, "Junior", "Managerial", vocab.NOT_STATED, "Senior", vocab.NOT_STATED,
        "Managerial", "Mid", "Junior"]


def test_level_text_reads_description(spark):
    df = spark.createDataFrame([("Engineer", "we need an expert"), (None, "fresh grad"), ("VP", None)], "t string, d string")
    got = [r[0] for r in df.select(rules.level_from_text(F.col("t"), F.col("d"))).collect()]
    assert got == ["Senior", "Junior", "Managerial"]


def test_level_maps(apply):
    labels = ["Mid", "Mid-level", "Intern", "Managerial", "Manager/Lead", "Manager/Head", "Senior", None]
    assert apply(rules.level_map_regex, labels) == [
        "Mid-level", "Mid-level-level", "Junior", "Manager/Head", "Manager/Head", "Manager/Head", "Senior", None]
    assert apply(rules.level_map_regex, ["Mid Intern"]) == ["Mid-level Junior"]
    assert apply(rules.level_map_exact, labels) == [
        "Mid", "Mid-level", "Junior", "Managerial", "Manager/Lead", "Manager/Head", "Senior", None]
    assert apply(rules.level_map_anchored, labels) == [
        "Mid-level", "Mid-level", "Junior", "Manager/Head", "Manager/Head", "Manager/Head", "Senior", None]


def test_bands_are_right_closed(apply):
    assert apply(lambda c: rules.band(c, vocab.SKILL_COUNT_BANDS), [0, 1, 2, 3, 8, 9, 100, 120, None], "int") == [
        None, "0–2", "0–2", "3–4", "7–8", "9+", "9+", "9+", None]
    assert apply(lambda c: rules.band(c, vocab.COMPANY_SIZE_BANDS), [1, 3, 10, 11, 9999, 20000], "int") == [
        "Small (1–2)", "Medium (3–5)", "Large (6–10)", "Enterprise (10+)", "Enterprise (10+)", "Enterprise (10+)"]


@pytest.mark.parametrize("raw, low, high, shown", [
    (None, None, None, vocab.NOT_STATED), ("", None, None, vocab.NOT_STATED), ("nan", None, None, vocab.NOT_STATED),
    (vocab.NOT_STATED, None, None, vocab.NOT_STATED),
    ("Rp 5.000.000 - Rp 8.000.000", 5000000, 8000000, "Rp 5.000.000 – Rp 8.000.000"),
    (f"Rp{NBSP}7,500,000 – Rp{NBSP}9,000,000 per month", 7500000, 9000000, "Rp 7.500.000 – Rp 9.000.000"),
    ("5jt-8jt", 5000000, 8000000, "Rp 5.000.000 – Rp 8.000.000"),
    ("5-8 juta", 8000000, 8000000, "Rp 8.000.000 – Rp 8.000.000"),
    (f"5,5{NBSP}JUTA", 5500000, 5500000, "Rp 5.500.000 – Rp 5.500.000"),
    ("50000", None, None, vocab.NOT_STATED), ("call us", None, None, vocab.NOT_STATED),
    ("5,000,000.50", 500000050, 500000050, "Rp 500.000.050"),
    ("Rp 9.000.000 - Rp 4.000.000", 4000000, 9000000, "Rp 4.000.000 – Rp 9.000.000"),
    ("Rp 6.000.000", 6000000, 6000000, "Rp 6.000.000"),
    ("Rp 6.000.000 (min. 2 years)", 6000000, 6000000, "Rp 6.000.000"),
])
def test_salary_text(apply, raw, low, high, shown):
    got = apply(salary.parse, [raw])[0]
    assert (got["salary_min"], got["salary_max"], got["salary_display"]) == (low, high, shown)


def test_salary_midpoint(spark):
    df = spark.createDataFrame([(2, 4), (None, 4), (2, None), (None, None), (1, 2)], "a bigint, b bigint")
    got = [r[0] for r in df.select(salary.midpoint(F.col("a"), F.col("b"))).collect()]
    assert got == [3.0, 4.0, 2.0, None, 1.5]


@pytest.mark.parametrize("raw, want", [
    ("React Native and React", ["react", "react native"]), ("react native", ["react", "react native"]),
    ("c++ daily", []), ("c++x", ["c++"]), ("c#, c#1", ["c#"]), ("nosql", []), ("SQL; nosql", ["sql"]),
    ("èr", []), ("r, R; python_3 python", ["python", "r"]), ("", []), (None, []), ("python python", ["python"]),
    ("scikit-learn ci/cd", ["ci/cd", "scikit-learn"]), ("spring  boot", []), ("Spring Boot", ["spring boot"]),
    ("go-lang", ["go"]), ("gitlab ci", ["gitlab ci"]),
])
def test_whole_words(apply, raw, want):
    assert apply(skills.whole_words, [raw]) == [want]


def test_whole_words_strict(apply):
    got = apply(lambda c: skills.whole_words(c, strict_tokens=True), ["c++ daily", "c++x", "c", "java, c#"])
    assert got == [["c++"], [], [], ["c#", "java"]]


def test_substrings(apply):
    assert apply(skills.substrings, ["Scalable JavaScript", "nosql", "", None]) == [
        ["java", "javascript", "scala"], ["sql"], [], []]


def _refit(title):
    """Similarity by the definition: a corpus of the roles plus this title."""
    docs = [c for _, c in similarity.role_term_counts()] + [Counter(similarity._terms(title))]
    n = len(docs)
    df = Counter(t for d in docs for t in d)
    vec = [{t: c * (math.log((1 + n) / (1 + df[t])) + 1) for t, c in d.items()} for d in docs]
    norm = [math.sqrt(sum(x * x for x in v.values())) for v in vec]
    q = vec[-1]
    return [sum(w * v.get(t, 0) for t, w in q.items()) / (m * norm[-1]) if norm[-1] else 0.0
            for v, m in zip(vec[:-1], norm[:-1])]


def test_role_similarity_equals_refit(spark):
    titles = ["AI Specialist", "IT Support", "Senior data engineer platform", "developer developer", "x", "", "zebra crossing",
              "quality of software, quality", "Machine Learning Lead", "web", "é data"]
    df = spark.createDataFrame(list(enumerate(titles)), "i int, t string")
    rows = similarity.with_role_scores(df, "t", "s").orderBy("i").collect()
    for row, title in zip(rows, titles):
        assert row["s"] == pytest.approx(_refit(title), abs=1e-12), title


def test_standard_role(spark):
    titles = ["AI Engineer", "AI Specialist", "Analytics Engineer", "IT Support", "", None, "zebra"]
    df = spark.createDataFrame(list(enumerate(titles)), "i int, t string")
    got = [r["standardized_role"] for r in similarity.with_standard_role(df, "t").orderBy("i").collect()]
    assert got == ["ML Engineer", "ML Engineer", "Data Analyst", "Other", "Other", "Other", "Other"]
    near = similarity.with_role_by_similarity(df, "t").orderBy("i").collect()
    assert near[1]["similarity"] == pytest.approx(0.2155, abs=5e-5)
    assert near[3]["similarity"] == pytest.approx(0.0788, abs=5e-5)


def test_cosine(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 1.0]), (3, [0.0, 0.0]), (4, [2.0, 0.0])], "i int, v array<double>")
    got = similarity.nearest(df, "v", F.array(F.lit(1.0), F.lit(0.0)), 3, ["i"]).collect()
    assert [r["i"] for r in got] == [1, 4, 2] and got[2]["similarity"] == pytest.approx(math.sqrt(0.5))
