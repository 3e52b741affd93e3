"""Alignment of wide pages: the same rule whatever the size."""

import functools
import random

from folkmoot.llm import extraction


def test_many_unlike_children_are_weighed_as_few_are(monkeypatch):
    rng = random.Random(4)

    def tree(depth):
        tag = rng.choice(["div", "section", "p"] if depth else ["p"])
        return f"<{tag}>" + ("".join(tree(depth - 1) for _ in range(rng.choice([0, 1, 2, 3, 9]))) if tag != "p" else "t") + f"</{tag}>"

    def plain(a, b):
        @functools.cache
        def weight(x, y):
            if a.tags[x] != b.tags[y]:
                return 0
            xs, ys = a.children[x], b.children[y]
            best = [[0] * (len(ys) + 1) for _ in range(len(xs) + 1)]
            for i, u in enumerate(xs):
                for j, v in enumerate(ys):
                    best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + weight(u, v))
            return best[-1][-1] + 1

        return weight(0, 0)

    # 230 by 230 unlike subtrees, beyond PAIRS: the matching is the largest there is
    wide = lambda: extraction.Page("<body>" + "".join("<div>" + "".join(rng.choice(["<p>x</p>", "<ul><li>a</ul>", "<div>y</div>"]) for _ in range(8)) + "</div>" for _ in range(230)) + "</body>")
    a, b = wide(), wide()
    assert len(extraction.align(a, b)) == plain(a, b)
    pages = [extraction.Page("".join(tree(3) for _ in range(4))) for _ in range(40)]
    pairs = [*zip(pages, pages[1:])]
    few = [extraction.align(a, b) for a, b in pairs]
    assert [len(x) for x in few] == [plain(a, b) for a, b in pairs]
    monkeypatch.setattr(extraction, "PAIRS", 0)  # always many at a time
    assert [extraction.align(a, b) for a, b in pairs] == few
    monkeypatch.setattr(extraction, "TABLE", 3)  # and a few rows at a time
    monkeypatch.setattr(extraction, "CELLS", 256)
    assert [extraction.align(a, b) for a, b in pairs] == few
