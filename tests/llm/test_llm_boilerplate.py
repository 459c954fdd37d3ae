"""Boilerplate is removed whatever pages hold it; near copies count once."""

from remitlens.llm import quality


def words(name, n):
    return " ".join(name + "".join("abcdefghij"[int(c)] for c in str(k)) for k in range(n))


def spell(i):
    return "".join("abcdefghij"[int(c)] for c in str(i))


def test_stub_pages_are_rejected_and_near_copies_do_not_decide(spark):
    menu = "\n".join(words(f"menu{chr(97 + k)}", 20) for k in range(4))
    rows = [(i, f"{menu}\n{words('own' + spell(i) + 'x', 20)}", "stubs") for i in range(60)]
    notice = words("notice", 18)
    body = "\n".join(words(f"body{chr(97 + k)}", 30) for k in range(6))
    rows += [(1000 + i, f"{notice}\n{body}\nedited {spell(i)}", "mixed") for i in range(80)]
    rows += [(2000 + i, f"{notice}\n{words('text' + spell(i) + 'x', 200)}", "mixed") for i in range(25)]
    got = {r.doc_id: r for r in quality.judge(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert not any(got[i].kept for i in range(60))
    assert all(got[1000 + i].kept and got[1000 + i].removed_words == 18 for i in range(80))
    assert all(got[2000 + i].kept and got[2000 + i].removed_words == 18 for i in range(25))
