"""Made-up texts with nulls, copies, long words and other hard cases."""

EXTRA = {c: "x" for c in ("row", "rid", "words", "fp", "kept", "text2", "ids", "cell", "spans", "topic")}
PROSE = "the of and to in that it was for on are as with they at be this have from or had by but not what all were".split()


def prose(seed: int, n: int) -> str:
    out, state = [], seed * 7919 + 17
    for i in range(n):
        state = (state * 1103515245 + 12345) % (1 << 31)
        word = PROSE[state >> 8 & 15] if state % 3 else PROSE[state >> 9 & 15] + PROSE[state >> 13 & 15]
        out.append(word.capitalize() + "." if i % 11 == 10 else word)
        if i % 40 == 39:
            out.append("\n")
    return " ".join(out)


def texts() -> list[tuple]:
    shared = prose(999, 70)
    long = prose(5, 9000)
    rows = [(i, prose(i, 30 + 9 * i), "en" if i % 3 else "de", f"s{i % 4}") for i in range(1, 46)]
    rows += [(100 + i, prose(200 + i, 60) + "\n" + shared + "\n" + prose(300 + i, 60), "en", "s0") for i in range(6)]
    rows += [(110 + i, prose(7, 150), "en", "s1") for i in range(4)]  # copies
    rows += [(120 + i, prose(8, 400).replace("with", "with" if i else "wich", 1), None, "s1") for i in range(2)]  # near copies
    rows += [
        (150, None, "en", None), (151, "", None, "s0"), (152, " \n\t\x0b ", "en", "s0"), (153, "a", "en", "s0"),
        (None, prose(40, 90), "en", "s0"), (None, None, None, None), (155, long, "en", "s2"), (155, long, "en", "s2"),
        (156, "same words here " * 40, "en", "s3"), (157, "line one is here\n" * 30, "en", "s3"),
        (158, "é" * 400 + " ünïcode ▁ 😀  x y " + prose(60, 40), "fr", "s0"),
        (159, "%%% $$$ ### " * 60, "en", "s1"), (160, prose(61, 80) + " Released under the MIT License.", "en", "s1"),
        (161, "MIT  LICENSE mit-license apache\nlicense, the GNU General Public License, version 3 " + prose(62, 30), "en", "s1"),
        (162, "Mail a.b@c.example.org or x@y.z, from 10.0.0.1 or 999.1.1.1; card 4539 1488 0343 6467, "
              "call +1 (212) 555-0100. " + prose(63, 30), "en", "s2"),
        (163, "Licensed under the Apache indeed License, Version 2.0 " + prose(64, 30), "en", "s2"),
        (164, "x" * 5000, "en", "s2"), (165, "ab" * 3000 + " " + "1" * 5000 + " @" * 30, "en", "s2"),
    ]
    return rows
