import re

import duckdb

from tabwright.llm.licences import TEMPLATES, scan
from tabwright.llm.queries import oracle_sql

SCHEMA = "doc_id bigint, text string, licence string"


def rows():
    mit = TEMPLATES["MIT-grant"]
    half = mit.replace(" the Software", "\nthe software", 2)
    out = [(1, "x\nReleased under the MIT License.\ny"), (2, half), (3, f"Title\n\n{half.upper()}\n--\nend"), (4, None), (5, ""), (6, "... \n\n"), (7, "word " * 100_000), (8, mit.replace("Software", "program")), (9, "Released under the MIT licence.")]
    out += [(10, TEMPLATES["GPL-3.0"] + " Extra words that dilute the notice a little"), (11, TEMPLATES["CC-BY-4.0"]), (11, TEMPLATES["CC-BY-4.0"]), (12, "É released under the MIT License")]
    out += [(20, f"{mit}\n\n{mit} {mit}"), (21, "one"), (22, f"{mit[: len(mit) * 6 // 7]}")]
    return out + [(100 + i, text) for i, (_, text) in enumerate(NOTICES.values())]


def wrapped(text, mark="", width=70):
    lines, line = [], ""
    for word in text.split():
        if len(line) + len(word) > width:
            lines.append(line)
            line = ""
        line = f"{line} {word}".strip()
    return "\n".join(f"{mark}{x}" for x in [*lines, line])


_MIT, _APACHE, _GPL, _BSD = TEMPLATES["MIT-full"], TEMPLATES["Apache-2.0-header"], TEMPLATES["GPL-3.0-header"], TEMPLATES["BSD-3-Clause"]
_HEADER = "Licensed under the Apache License, Version 2.0 (the \"License\");\nyou may not use this file except in compliance with the License.\nYou may obtain a copy of the License at\n\n    http://www.apache.org/licenses/LICENSE-2.0\n\nUnless required by applicable law or agreed to in writing, software\ndistributed under the License is distributed on an \"AS IS\" BASIS,\nWITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.\nSee the License for the specific language governing permissions and\nlimitations under the License."
_PARTS = [_MIT.index("The above copyright"), _MIT.index("THE SOFTWARE IS")]
#: Canonical layouts of notices, and the template that must be found in each.
NOTICES = {
    "MIT with blank lines": ("MIT-full", "MIT License\n\nCopyright (c) 2020 Jane Doe\n\n" + "\n\n".join(wrapped(x) for x in (_MIT[: _PARTS[0]], _MIT[_PARTS[0] : _PARTS[1]], _MIT[_PARTS[1] :]))),
    "MIT without blank lines": ("MIT-full", "The MIT License (MIT)\nCopyright (c) 2020 Jane Doe and others\n" + wrapped(_MIT) + "\nint main() { return 0; }"),
    "MIT on one line": ("MIT-full", "Copyright 2020 Jane Doe " + _MIT + " And on goes the page with other words."),
    "BSD-3 in list items": ("BSD-3-Clause", "Copyright (c) 2019, Jane Doe\nAll rights reserved.\n\n" + re.sub(r" (\d\.)", r"\n\n\1", wrapped(_BSD).replace("\n", " "))),
    "Apache behind #": ("Apache-2.0-header", "#!/bin/sh\n# Copyright 2021 Jane Doe\n#\n" + "\n".join(f"# {x}".rstrip() for x in _HEADER.split("\n")) + "\necho hi"),
    "Apache behind //": ("Apache-2.0-header", "\n".join(f"// {x}".rstrip() for x in _HEADER.split("\n")) + "\npackage x"),
    "Apache behind *": ("Apache-2.0-header", "/*\n * Copyright 2021 Jane Doe\n *\n" + "\n".join(f" * {x}".rstrip() for x in _HEADER.split("\n")) + "\n */\nclass X {}"),
    "GPL header": ("GPL-3.0-header", "prog - does things\nCopyright (C) 2018 Jane Doe\n\n" + wrapped(_GPL).replace("This program is distributed", "\n\nThis program is distributed") + "\n\nYou should have received a copy of the GNU General Public License\nalong with this program. If not, see <https://www.gnu.org/licenses/>."),
    "inside a line": ("CC-BY-NC-4.0", "Copyright 2021 Jane Doe. Licensed under CC BY-NC 4.0."),
}


def brute(rows, t):
    words = lambda x: re.findall("[a-z0-9]+", re.sub("[A-Z]", lambda m: m.group().lower(), x))
    grams = lambda w: set(zip(w, w[1:]))
    dice = lambda g, h: 2 * len(g & h) / (len(g) + len(h))
    out = []
    for d, text in rows:
        lines = (text or "").split("\n")
        cut = [-1, *[i for i, x in enumerate(lines) if not re.search("[A-Za-z0-9]", x)], len(lines)]
        parts = [("line", i, 1, x) for i, x in enumerate(lines)] + [("paragraph", a + 1, b - a - 1, "\n".join(lines[a + 1 : b])) for a, b in zip(cut, cut[1:]) if b - a > 2]
        for unit, i, n, x in parts:
            g = grams(words(x))
            out += [(d, unit, i, n, k, round(dice(g, grams(words(v))), 9)) for k, v in TEMPLATES.items() if g and dice(g, grams(words(v))) >= t]
        w, ln = words(text or ""), [i for i, x in enumerate(lines) for _ in words(x)]
        if len(w) < 2 or len(w) > 50_000:
            continue
        for k, v in TEMPLATES.items():
            n, h, last, best = min(len(words(v)), len(w)), grams(words(v)), None, []
            for s in range(len(w) - n + 1):
                g = grams(w[s : s + n])
                if g and dice(g, h) >= t:
                    if last is None or 2 * (s - last) >= n:
                        best.append((s, dice(g, h)))
                    elif dice(g, h) > best[-1][1]:
                        best[-1] = (s, dice(g, h))
                    last = s
            out += [(d, "window", ln[s], ln[s + n - 1] - ln[s] + 1, k, round(x, 9)) for s, x in best]
    return sorted(out)


def test_scan_against_brute_force(spark):
    df = spark.createDataFrame([(i, t, "x") for i, t in rows()] + [(None, TEMPLATES["MIT-grant"], "x")], SCHEMA)
    for t in (0.8, 0.5):
        got = sorted((r.doc_id, r.unit, r.line, r.n_lines, r.licence, round(r.dice, 9)) for r in scan(df, t).collect())
        assert got == brute(rows(), t) and got
    assert scan(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_scan_against_sql(spark, tmp_path):
    df = spark.createDataFrame([(i, t, "x") for i, t in rows() if i != 7], SCHEMA)
    df.coalesce(1).write.parquet(f"{tmp_path}/d")
    with duckdb.connect() as con:
        con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/d/*.parquet'")
        want = sorted(con.sql(oracle_sql()["op10_licence_dice"]).fetchall())
    assert sorted((r.doc_id, r.unit, r.line, r.n_lines, r.licence, round(r.dice, 6)) for r in scan(df).collect()) == want


def test_canonical_notices_are_found_and_plain_text_is_not(spark):
    df = spark.createDataFrame([(i, text, name) for i, (name, (_, text)) in enumerate(NOTICES.items())], SCHEMA)
    found = {(r.doc_id, r.licence) for r in scan(df).collect()}
    assert [name for i, (name, (k, _)) in enumerate(NOTICES.items()) if (i, k) not in found] == []
    plain = ["The License of the bar was under review.", "Permission was granted to use the room for any purpose.", "This program is distributed by the theatre.", "Redistribution of wealth and use of land, with or without reform, are debated."]
    assert scan(spark.createDataFrame([(i, t, "") for i, t in enumerate(plain)], SCHEMA)).count() == 0
