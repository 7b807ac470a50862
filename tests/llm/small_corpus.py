"""A small corpus with every awkward case: nulls, empty and long texts, ties, repeated rows."""

import random

WORDS = [a + b for a in "ba ce di fo gu ha je ki lo mu na pe".split() for b in "lan mer tis ron vak sol dim pu".split()]
ITEM = "The quiet harbour keeps seven painted boats whose owners never learned to swim in cold northern water at night"


def prose(rng, n, mark=""):
    out = []
    while len(out) < n:
        sentence = [rng.choice(WORDS) for _ in range(rng.randint(4, 12))]
        out += [sentence[0].capitalize(), *sentence[1:-1], sentence[-1] + mark + "."]
    return " ".join(out[:n])


def corpus():
    rng = random.Random(7)
    shared = prose(rng, 70)
    rows = []
    for i in range(60):
        lines = [prose(rng, rng.randint(60, 160)), prose(rng, rng.randint(5, 30))]
        if i % 4 == 0:
            lines.insert(1, shared)
        if i % 3 == 0:
            lines.append("All pages of this site end with this line 2024.")
        rows.append((i, "\n".join(lines), "en" if i % 2 else "xx", f"s{i % 4}" if i % 7 else None))
    base = rows[1][1]
    rows.append((60, base, "en", "s1"))
    rows.append((61, base.replace(WORDS[3], "changed"), "en", "s1"))
    rows.append((62, base + " one more word here", "en", "s9"))
    rows.append((63, " ".join(f"{w}***" for w in base.split()), "en", "s1"))
    rows.append((64, "again " * 200, "en", "s1"))
    rows.append((65, prose(rng, 80) + "\n" + ITEM + "\n" + prose(rng, 20), "en", "s2"))
    words = ITEM.split()
    words[5], words[11] = "blue", "wanted"
    rows.append((66, prose(rng, 50) + " " + " ".join(words) + " " + prose(rng, 20), None, "s2"))
    rows.append((67, prose(rng, 30_000), "en", "s3"))
    rows += [(68, None, "en", "s3"), (69, "", "en", "s3"), (70, " \n\t ", None, None), (71, "two words", "en", "s0"),
             (72, "TWO words", "en", "s0"), (None, "no id here at all", "en", "s0"), (None, None, None, None),
             (73, "12 34 !?", "en", "s0"), (74, "Ünïcödé ÄÖÜ ŒUVRE ñandú 日本語 文字 \U0001F600 ok", "xx", "s0")]
    rows += [rows[5], rows[5], rows[-1]]
    return rows


PAGES = [
    (i, f"https://Site.example.com/{i}" if i < 12 else None,
     f"<html><head><title>t</title></head><body><div>Welcome to the site<ul><li>Home<li>News</ul></div>"
     f"<main><p>Body {i} &amp; more&nbsp;text<p>Second   {i}<div class='cookie-notice'>We use cookies</div></main>"
     f"<p>Read our terms</p></body></html>")
    for i in range(14)
] + [(20, "bad url", None), (21, "http://h/", ""), (22, "http://h/", "<p>open <b>bold <!-- never closed <p>lost"), (None, None, "text & only")]
