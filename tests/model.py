"""Plain row walk of the linking rules, used to check the Spark jobs row for row."""

from collections import defaultdict


def walk(supply, wanted):
    """Ids linked by the individual rule; both are lists of (id, quantity) in row order."""
    if not supply or not wanted:
        return []
    left, out, rest = list(supply), [], []
    for wid, q in wanted:
        twin = next((i for i, (_, a) in enumerate(left) if a == q), None)
        if twin is None:
            rest.append((wid, q))
        else:
            left.pop(twin)
            out.append(wid)
    if left:
        budget = sum(q for _, q in left)
        for wid, q in sorted(rest, key=lambda r: -r[1]):
            if budget >= q:
                out.append(wid)
                budget -= q
    return out


def link_day(rows):
    """{row id: comment} of one date. Rows: dicts id, group, blank, later, sblt, side, qty, ref."""
    rows = sorted(rows, key=lambda r: r["id"])
    later = [r for r in rows if r["later"] and not r["sblt"]]
    flag = {r["id"]: 0 for r in later}
    why = {}

    def mark(ids, text):
        for i in ids:
            flag[i] = 1
            why[i] = text

    def pull(text):
        refs = {r["ref"] for r in later if flag[r["id"]]}
        mark([r["id"] for r in later if not flag[r["id"]] and r["ref"] in refs], text)

    named = [r for r in rows if not r["sblt"] and not r["blank"]]
    groups = defaultdict(list)
    for r in named:
        groups[r["group"]].append(r)
    total, single = [], []
    for members in groups.values():
        for side, other in (("S", "B"), ("B", "S")):
            a = [(r["id"], r["qty"]) for r in members if not r["later"] and r["side"] == other]
            b = [(r["id"], r["qty"]) for r in members if r["later"] and r["side"] == side]
            if sum(q for _, q in a) >= sum(q for _, q in b):
                total += [i for i, _ in b]
            else:
                single += walk(a, b)
    mark(total, "Total amount linking")
    mark(single, "Individual linking")
    pull("PSMS reference matching")

    groups = defaultdict(list)
    for r in later:
        groups[r["group"]].append(r)
    n = 1
    while True:
        total, single = [], []
        for members in groups.values():
            for side, other in (("S", "B"), ("B", "S")):
                a = [(r["id"], r["qty"]) for r in members if flag[r["id"]] and r["side"] == other]
                b = [(r["id"], r["qty"]) for r in members if not flag[r["id"]] and r["side"] == side]
                if not a or not b:
                    continue
                if sum(q for _, q in a) >= sum(q for _, q in b):
                    total += [i for i, _ in b]
                else:
                    single += walk(a, b)
        if not total and not single:
            return why
        n += 1
        mark(total, f"Total amount linking at Turnaround {n} ")
        mark(single, f"Individual linking at Turnaround {n} ")
        pull(f"PSMS reference matching at Turnaround {n} ")


def link_all(prepared):
    """{(date, row id): comment} for prepared Spark rows."""
    days = defaultdict(list)
    for r in prepared:
        if r.subsequent == "DCSS":
            continue
        days[r.SettlementDate].append({
            "id": r.row_id, "group": r.Code_CDP, "blank": not r.CDPSafeKeepingAccount,
            "later": r.subsequent == "1", "sblt": r.TransferType == "SBLT",
            "side": r.BuySellIndicator, "qty": r.Quantity, "ref": r.PSMSMatchedReference,
        })
    return {(d, i): c for d, rows in days.items() for i, c in link_day(rows).items()}
