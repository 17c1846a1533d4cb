from pyspark.sql import functions as F

from logsense.functions import correction as C

TERMS = ("admin", "root", "null", "C++", "", "root")
#: (template, corrected, corrected with the terms above).
CASES = [
    ('took 12 ms', 'took <*> ms', 'took <*> ms'),
    ('id42 42id 4.2', 'id42 42id <*>', 'id42 42id <*>'),
    ('True or FALSE or untrue', '<*> or <*> or untrue', '<*> or <*> or untrue'),
    ('open C:\\Windows\\sys.dll now', 'open <*> now', 'open <*> now'),
    ('at D:\\a\\b\\ end', 'at <*> end', 'at <*> end'),
    ('read /var/log/x.log ok', 'read <*> ok', 'read <*> ok'),
    ('~/home/me/ done', '<*> done', '<*> done'),
    ('a/b/c not', 'a/b/c not', 'a/b/c not'),
    ('https://site.org/x/y', 'https:<*>', 'https:<*>'),
    ('admin ROOT nullable null C++ c++11', 'admin ROOT nullable null C++ <*>', '<*> nullable <*>'),
    ('user=<*> a,<*>x (<*>) {k: v<*>}', '<*> a,<*> (<*>) {k: <*>}', '<*> a,<*> (<*>) {k: <*>}'),
    ('<*>.<*> . <*>', '<*>', '<*>'),
    ('<*> <*><*> x <*>', '<*> x <*>', '<*> x <*>'),
    ('a  b\t\tc ', 'a b c', 'a b c'),
    ('', '', ''),
    ('   ', '', ''),
    ('\u0661\u0662 \xe912 12\xe9', '<*> \xe912 12\xe9', '<*> \xe912 12\xe9'),
    ('port:8080;[99]', 'port:<*>;[<*>]', 'port:<*>;[<*>]'),
    ('v<*>w<*>z', '<*>', '<*>'),
    ('{"k": 69}', '{"k": <*>}', '{"k": <*>}'),
    ("x" * 300 + " 5", "x" * 300 + " <*>", "x" * 300 + " <*>"),
    ('/', '/', '/'),
    ('//', '//', '//'),
    ('/a//b', '<*>', '<*>'),
    ('e.g. /usr/lib, /bin', 'e.g. <*>, <*>', 'e.g. <*>, <*>'),
    ('\xa0 7 \xa0', '<*>', '<*>'),
]


def test_rules(spark):
    df = spark.createDataFrame([(i, case[0]) for i, case in enumerate(CASES)], "i int, s string")
    for column, terms in ((1, ()), (2, TERMS)):
        got = {r.i: r.c for r in df.select("i", C.correct_template(F.col("s"), terms).alias("c")).collect()}
        assert got == {i: case[column] for i, case in enumerate(CASES)}


def test_null_second_pass_and_switch(spark):
    df = spark.createDataFrame([(None,), ("a 1",)], "template string")
    assert [r[0] for r in df.select(C.correct_template(F.col("template"))).collect()] == ["", "a <*>"]
    twice = C.correct_template(C.correct_template(F.col("template")))
    assert [r[0] for r in df.select(twice).collect()] == ["", "a <*>"]
    off = C.with_correction(df.filter("template IS NOT NULL"), False).first()
    on = C.with_correction(df.filter("template IS NOT NULL"), True).first()
    assert (off.corrected_template, off.was_corrected) == ("a 1", False)
    assert (on.corrected_template, on.was_corrected) == ("a <*>", True)
