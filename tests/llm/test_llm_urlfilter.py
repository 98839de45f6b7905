import datetime as dt
import random

from settleline.llm import urlfilter as U

DAY0 = dt.datetime(2024, 1, 1)


def day(n):
    return None if n is None else DAY0 + dt.timedelta(days=n)


def frames(spark, captures, events):
    c = spark.createDataFrame([(i, u, day(t), "clash", 3) for i, u, t in captures], "page_id long, url string, fetch_time timestamp, kind string, valid_from int")
    e = spark.createDataFrame([(*x[:5], day(x[5]), "clash") for x in events],
                              "list_name string, action string, kind string, key string, event string, at timestamp, url string")
    return c, e


def host_and_path(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = rest[:cut].rsplit("@", 1)[-1].split(":")[0].lower()
    host = host[4:] if host.startswith("www.") else host
    path = rest[cut:] if rest[cut:cut + 1] == "/" else ""
    return host.removesuffix("."), path.split("?")[0].split("#")[0]


def brute(captures, events):
    intervals = []
    for entry in {x[:4] for x in events}:
        times = {}
        for x in events:
            if x[:4] == entry and x[5] is not None:
                times[x[5]] = min(times.get(x[5], "z"), x[4])
        order = sorted(times)
        intervals += [(*entry, t, order[k + 1] if k + 1 < len(order) else None) for k, t in enumerate(order) if times[t] == "add"]
    out = []
    for i, url, t in captures:
        host, path = host_and_path(url)
        met = []
        for name, action, kind, key, lo, hi in intervals:
            if not host or t is None or t < lo or (hi is not None and t >= hi):
                continue
            if kind == "host" and host == key or kind == "domain" and (host == key or host.endswith("." + key)) or \
                    kind == "prefix" and ((host + path).startswith(key) if key.endswith("/") else host + path == key):
                met.append((-U.RANK[kind], -len(key), action, name, kind, key))
        best = min(met, default=None)
        out.append((i, best is None or best[2] != "block", best and best[3], best and best[4], best and best[5]))
    return sorted(out, key=str)


def run(spark, captures, events):
    out = U.filter_captures(*frames(spark, captures, events)).collect()
    return sorted([(r.page_id, r.kept, r.list_name, r.kind, r.key) for r in out], key=str)


def test_random_against_brute_force(spark):
    rng = random.Random(4)
    hosts = ["a.com", "x.a.com", "y.x.a.com", "b.org", "www.b.org", "c.net"]
    keys = {"domain": ["a.com", "x.a.com", "b.org", "com"], "host": ["a.com", "x.a.com", "b.org"], "prefix": ["a.com/p/", "a.com/p/q", "b.org/", "x.a.com/p/q/"]}
    events = []
    for _ in range(120):
        kind = rng.choice(list(keys))
        events.append((f"l{rng.randint(0, 2)}", rng.choice(["block", "block", "allow"]), kind, rng.choice(keys[kind]), rng.choice(["add", "remove"]), rng.randint(0, 20)))
    captures = [(i, f"{rng.choice(['http', 'HTTPS'])}://{rng.choice(['', 'u@'])}{rng.choice(hosts)}{rng.choice(['', ':80'])}{rng.choice(['', '/', '/p', '/p/', '/p/q', '/p/q/r?x=1#y', '/z/p'])}",
                 rng.randint(0, 25)) for i in range(400)]
    assert run(spark, captures, events) == brute(captures, events)


def test_interval_ends(spark):
    events = [("l", "block", "host", "a.com", "add", 3), ("l", "block", "host", "a.com", "remove", 5), ("l", "block", "host", "a.com", "add", 8)]
    captures = [(t, "http://a.com/", t) for t in range(10)]
    assert [r[1] for r in run(spark, captures, events)] == [t not in (3, 4, 8, 9) for t in range(10)]


def test_odd_rows(spark):
    events = [("l", "block", "domain", "a.com", "add", 1), ("l", "block", "domain", None, "add", 1), ("l", "block", "host", "b.com", "add", None)]
    captures = [(1, None, 2), (2, "", 2), (3, "no url", 2), (4, "http://a.com/", None), (None, "http://a.com", 2), (6, "http://a.com/" + "d/" * 20000, 2),
                (6, "http://a.com/" + "d/" * 20000, 2), (7, "http:///path", 2), (8, "http://b.com", 2), (9, "http://nota.com", 2)]
    got = run(spark, captures, events)
    assert len(got) == 10 and [g[0] for g in got if not g[1]] == [6, 6, None]
    assert all(r[1] for r in run(spark, captures, []))
    assert run(spark, [], events) == []


def test_native_plan(spark):
    plan = U.filter_captures(*frames(spark, [(1, "http://a.com", 1)], [("l", "block", "host", "a.com", "add", 1)]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_entries_of_any_depth(spark):
    deep = "http://a.com/" + "d/" * 300
    events = [("l", "block", "prefix", "a.com/" + "d/" * 70, "add", 1), ("l", "allow", "prefix", "a.com/" + "d/" * 299, "add", 5),
              ("m", "block", "prefix", "b.com/page", "add", 1), ("m", "block", "domain", ".".join("x" * 140) + ".org", "add", 1)]
    host = ".".join("x" * 141) + ".org"
    captures = [(1, deep, 2), (2, deep, 6), (3, "http://a.com/" + "d/" * 69, 2), (4, "http://b.com/page", 2), (5, "http://b.com/pages", 2),
                (6, "http://b.com/page/1", 2), (7, f"http://{host}/", 2)]
    got = run(spark, captures, events)
    assert got == brute(captures, events)
    assert [r[1] for r in got] == [False, True, True, False, True, True, False]
