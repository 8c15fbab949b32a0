"""Plain versions of the operators, for small inputs."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

from recall.llm import html_extract

SPACES = re.compile(r"[^\x20\x09-\x0d]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return SPACES.findall(text or "")


def shingles(text, k=5):
    w = words(lower(text))
    return frozenset([tuple(w)] if 0 < len(w) < k else (tuple(w[i : i + k]) for i in range(len(w) - k + 1)))


def components(rows, percent=75):
    """[(doc_id, text)] -> [(doc_id, n_shingles, component_id)], a row each."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    have = defaultdict(list)
    for i, s in enumerate(sets):
        if rows[i][0] is None:
            continue
        shared = Counter()
        for t in s:
            shared.update(have[t])
            have[t].append(i)
        for j, o in shared.items():
            if 100 * o >= percent * (len(s) + len(sets[j]) - o):
                a, b = find(i), find(j)
                parent[a] = b
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return [(d, len(sets[i]), least[find(i)] if d is not None else None) for i, (d, _) in enumerate(rows)]


def without_repeats(rows, length=100):
    """[(doc_id, text)] with different ids -> {doc_id: (n_bytes, n_removed, n_spans, sha256)}."""
    seen, out = set(), {}
    for d, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            w = b[i : i + length]
            if w in seen:
                gone[i : i + length] = b"\1" * length
            seen.add(w)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        out[d] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def base_counts(text):
    w, t = words(text), text or ""
    lines = [x for x in t.split("\n") if SPACES.search(x)]
    runs = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    often = Counter(runs)
    covered = {i + j for i, r in enumerate(runs) if often[r] > 1 for j in range(8)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered)


def benchmark_pairs(docs, items, least=0.75, k=5):
    """{(doc_id, item_id)} with a window of the item's size that is similar enough."""
    bag = lambda w: Counter(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else Counter([tuple(w)] if w else [])
    texts = {i: words(lower(t)) for i, t in items}
    bags = {i: bag(w) for i, w in texts.items()}
    df = Counter(x for b in bags.values() for x in b)
    weigh = lambda x: math.log(1 + len(items) / df[x]) if x in df else math.log(1 + len(items))
    out = set()
    for d, t in docs:
        w = words(lower(t))
        for i, own in texts.items():
            for p in range(len(w) - len(own) + 1) if own else ():
                b = bag(w[p : p + len(own)])
                both = sum(min(c, bags[i][x]) * weigh(x) for x, c in b.items())
                if both and both >= least * (sum(c * weigh(x) for x, c in b.items()) + sum(c * weigh(x) for x, c in bags[i].items()) - both):
                    out.add((d, i))
                    break
    return out


def url_templates(pages, ratings, rules, support, alike, differs, prior, least):
    """{page_id: (host, path, rule, verdict)} by the template tree, a step at a time in plain loops."""
    rows = []
    for page, url in pages:
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        host = lower(re.match(r"[^/?#]*", rest)[0])
        path = re.match(r"[^/?#]*([^?#]*)", rest)[1]
        rows.append([page, host, path, path[1:].split("/") if path else [""], "", True])

    def close(level):
        nodes = defaultdict(list)
        for r in rows:
            if r[5]:
                nodes[r[1], r[4]].append(r)
        for own in nodes.values():
            marks = [ratings[r[0]] for r in own if r[0] in ratings]
            if not (max(len(r[3]) for r in own) > level and len(own) >= support and 0 < sum(marks) < len(marks)):
                for r in own:
                    r[5] = False

    level = 0
    close(0)
    while any(r[5] for r in rows):
        count, rated, good = Counter(), Counter(), Counter()
        live = [r for r in rows if r[5]]
        key = lambda r: (r[1], r[4], r[3][level] if level < len(r[3]) else "")
        for r in live:
            for k in (key(r), key(r)[:2]):
                count[k] += 1
                if r[0] in ratings:
                    rated[k] += 1
                    good[k] += ratings[r[0]]
        literal = defaultdict(list)
        for k in {key(r) for r in live}:
            up = k[:2]
            n, rest = rated[k], rated[up] - rated[k]
            if count[k] >= support and not re.fullmatch(r"[0-9]+(\.[A-Za-z]+)?", k[2]) and n and rest:
                p = good[up] / rated[up]
                if abs(good[k] / n - (good[up] - good[k]) / rest) > differs * math.sqrt(p * (1 - p) * (1 / n + 1 / rest)):
                    literal[(*up, math.floor(round(math.asin(math.sqrt((good[k] + 1) / (n + 2))) / (math.pi / 2 / alike), 9)))].append(k)
        step = {}
        for own in literal.values():
            first = min(k[2] for k in own)
            for k in own:
                step[k] = first + (f" +{len(own) - 1}" if len(own) > 1 else "")
        for r, k in [(r, key(r)) for r in live]:
            if level < len(r[3]):
                r[4] += "/" + step.get(k, "*")
            else:
                r[5] = False
        level += 1
        close(level)
    rated, good = Counter(), Counter()
    for r in rows:
        for k in ((r[1], r[4]), (r[1],), ()):
            if r[0] in ratings:
                rated[k] += 1
                good[k] += ratings[r[0]]
    every = good[()] / rated[()] if rated[()] else 1.0
    out = {}
    for page, host, path, _, t, _ in rows:
        up = (good[host,] + prior * every) / (rated[host,] + prior)
        purity = round((good[host, t] + prior * up) / (rated[host, t] + prior), 9)
        fit = [(len(r), r, v) for v, r in rules if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith(r[r.index("/") :])]
        rule, verdict = max(fit)[1:] if fit else (None, "block" if purity < least else "allow")
        out[page] = (host, path, rule, verdict)
    return out


def main_texts(rows):
    """{page_id: main text} of [(page_id, url, html)] by explicit occurrence vectors; tokens and blocks as the walk gives them."""
    out, hosts = {}, defaultdict(list)
    for page_id, url, source in rows:
        hosts[url.split("/")[2]].append((page_id, html_extract.Page(source)))
    for pages in hosts.values():
        vectors, kinds, anchors = defaultdict(lambda: [0] * len(pages)), {}, {}
        for i, (_, page) in enumerate(pages):
            for token, kind, anchor in page.tokens:
                vectors[token][i] += 1
                kinds[token], anchors[token] = kind, anchor
        classes = defaultdict(list)
        for token, v in vectors.items():
            classes[tuple(v)].append(token)
        large = {}
        for v, tokens in classes.items():
            contents = {pages[i][1].text() for i, n in enumerate(v) if n}
            if len(tokens) >= 3 and len(contents) >= 3 and any(kinds[t] == html_extract.TAG for t in tokens):
                large[v] = tokens
        of = {t: v for v, tokens in large.items() for t in tokens}
        orders, slots = defaultdict(set), defaultdict(set)
        for _, page in pages:
            spans = []
            for v, tokens in large.items():
                at = [(i, t) for i, (t, _, _) in enumerate(page.tokens) if of.get(t) == v]
                for j in range(0, len(at), len(tokens)):
                    turn = at[j : j + len(tokens)]
                    orders[v].add(tuple(t for _, t in turn))
                    spans.append((v, [i for i, _ in turn]))
            for v, own in spans:
                around = [(o[0], w, sum(i < own[0] for i in o)) for w, o in spans if w != v and o[0] < own[0] < o[-1]]
                slots[v].add(max(around)[1:] if around else None)
                if any(w != v and own[0] < i < own[-1] and (o[0] < own[0] or o[-1] > own[-1]) and o[0] < own[0] for w, o in spans for i in o):
                    orders[v].add("crosses")
        valid = {v for v, tokens in large.items() if len(orders[v]) == 1 and len(set(next(iter(orders[v])))) == len(tokens) and len(slots[v]) == 1}
        drop = {t for t, v in of.items() if v in valid and kinds[t] == html_extract.TEXT and of.get(anchors[t]) == v}
        for page_id, page in pages:
            out[page_id] = page.text({i for i, (t, _, _) in enumerate(page.tokens) if t in drop})
    return out


def kneser_ney_bits(rows, order=5, symbols=4096):
    """{doc_id: mean -log2 probability of the characters that end an n-gram} of [(doc_id, text, language)], by dictionaries."""
    plain = lambda t: re.sub(r"[\t\n\v\f\r]", " ", t or "")
    grams = lambda t: [t[i : i + order] for i in range(len(t) - order + 1)]
    counts = defaultdict(Counter)
    for _, text, lang in rows:
        counts[lang].update(grams(plain(text)))
    models = {}
    for lang, own in counts.items():
        levels = {order: own}
        for n in range(order - 1, 0, -1):
            levels[n] = Counter(g[1:] for g in levels[n + 1])
        model = {}
        for n, level in levels.items():
            n1, n2, n3, n4 = (sum(c == i for c in level.values()) for i in (1, 2, 3, 4))
            if min(n1, n2, n3, n4) == 0:
                cut = [0, 0.5, 1.0, 1.5]
            else:
                y = n1 / (n1 + 2 * n2)
                bounds = ((0.05, 0.95), (0.1, 1.9), (0.15, 2.85))
                cut = [0, *(min(max(x, lo), hi) for x, (lo, hi) in zip((1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3), bounds, strict=True))]
            total, given = Counter(), Counter()
            for g, c in level.items():
                total[g[:-1]] += c
            kept = {g: c for g, c in level.items() if c >= (1 if n < 3 else 2)}
            for g, c in kept.items():
                given[g[:-1]] += (c - cut[min(c, 3)]) / total[g[:-1]]
            model[n] = (kept, cut, total, given)
        models[lang] = model

    def p(model, g):
        if not g:
            return 1 / symbols
        kept, cut, total, given = model[len(g)]
        if g[:-1] not in given:
            return p(model, g[1:])
        c = kept.get(g, 0)
        return (c - cut[min(c, 3)]) / total[g[:-1]] + (1 - given[g[:-1]]) * p(model, g[1:])

    out = {}
    for doc, text, lang in rows:
        own = grams(plain(text))
        out[doc] = -sum(math.log2(p(models[lang], g)) for g in own) / len(own) if own else None
    return out


def perplexity_bands(rows, bits, passed, fence=3.0, short=400.0, step=1e-3):
    """{doc_id: kept} of [(doc_id, text, language)] with the bits of each, for those that pass the base rules."""
    by = defaultdict(list)
    for doc, _, lang in rows:
        if doc in passed and bits[doc] is not None:
            by[lang].append(math.floor(bits[doc] / step))
    out = {}
    for doc, text, lang in rows:
        out[doc] = False
        if doc in passed and bits[doc] is not None:
            x = sorted(by[lang])
            q1, q3 = (x[math.ceil(q * len(x)) - 1] * step for q in (0.25, 0.75))
            spread = max(q3 - q1, 0.02)
            slack = fence * spread * (math.sqrt(1 + short / max(1, sum(map(len, words(text))))) - 1)
            out[doc] = q1 - fence * spread - slack <= bits[doc] <= q3 + fence * spread + slack
    return out


def notices(words_, sets, least=0.75):
    """{license} of [(license, shingles, words, words of a shingle)] of which a stretch of the words holds enough shingles."""
    out = set()
    for name, own, size, k in sets:
        room = size + size // 8
        at = [tuple(words_[i : i + k]) for i in range(len(words_) - k + 1)]
        if any(len(own & set(at[i : i + room - k + 1])) >= least * len(own) for i in range(max(1, len(at) - (room - k)))):
            out.add(name)
    return out


def languages(rows, smooth=0.5):
    """{doc_id: (language, score)} of [(doc_id, text, language)] of ASCII letters, learned from those that are not held out."""
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 0
    names = sorted({lang for i, _, lang in rows if not held(i)})
    grams = lambda w, n: [x for j in range(len(w) + 3 - n) if (x := f" {w} "[j : j + n]) != " "]
    count = defaultdict(Counter)
    for i, text, lang in rows:
        if not held(i):
            for w in text.lower().split():
                count[0][w, lang] += 1
                for n in (4, 3, 2, 1):
                    for g in grams(w, n):
                        count[n][g, lang] += 1
    keys = {k: {x for x, _ in c} for k, c in count.items()}
    total = {k: Counter() for k in count}
    for k, c in count.items():
        for (_, lang), v in c.items():
            total[k][lang] += v
    log = lambda k, x, lang: math.log((count[k][x, lang] + smooth) / (total[k][lang] + smooth * (len(keys[k]) + 1)))
    out = {}
    for i, text, _ in rows:
        sums = dict.fromkeys(names, 0.0)
        for w in text.lower().split():
            kind, own = (0, [w]) if w in keys[0] else next(((n, found) for n in (4, 3, 2, 1) if (found := [g for g in grams(w, n) if g in keys[n]])), (0, []))
            for lang in names:
                sums[lang] += sum(log(kind, x, lang) for x in own) / max(1, len(own))
        best = max(sorted(names), key=lambda x: sums[x])
        out[i] = best, 1 / sum(math.exp(v - sums[best]) for v in sums.values())
    return out


def bm25(docs, seed, k1, b):
    """Score of each document for the words of ``docs[seed]``; words of one document and those of most don't count."""
    df = Counter(w for x in docs for w in set(x))
    mean = max(1.0, sum(map(len, docs)) / len(docs))
    idf = {w: math.log((len(docs) - n + 0.5) / (n + 0.5)) for w, n in df.items() if n > 1}
    out = []
    for x in docs:
        tf = Counter(x)
        out.append(sum(idf[w] * tf[w] * (k1 + 1) / (tf[w] + k1 * (1 - b + b * len(x) / mean)) for w in set(docs[seed]) if w in tf and idf.get(w, 0) > 0))
    return out
