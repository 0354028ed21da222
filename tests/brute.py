"""Scenarios by plain loops over dictionaries: slow, small, and written from
the definitions. Used as the expected side of the tests."""

from __future__ import annotations

import hashlib


def key(ticker):
    return hashlib.md5(ticker.encode()).hexdigest(), ticker


def draw(seed, sim, day_idx, ticker):
    return int(hashlib.md5(f"{seed}|{sim}|{day_idx}|{ticker}".encode()).hexdigest()[:8], 16)


def reason(entry, today, mode, stop=2.0, flat=0.1):
    if mode == "code":
        return "STOP_LOSS" if entry - stop < today else "PLATEAU" if entry + flat < today else None
    return "STOP_LOSS" if today < entry - stop else "PLATEAU" if abs(today - entry) <= flat else None


def choose(seed, sim, day_idx, ticker, owned, universe, tradable):
    """The replacement for one sale, or None."""
    pool = [t for t in universe if t not in owned] or list(universe)
    candidates = sorted((t for t in pool if t in tradable), key=key)
    if not candidates:
        return None
    return candidates[draw(seed, sim, day_idx, ticker) % len(candidates)]


def run(prices, chosen, *, n_sims, money, seed, mode="code", universe=None, in_order=False):
    """prices: {(ticker, day): price}. Returns ({(sim, day): total},
    {(sim, day, ticker): units})."""
    days = sorted({d for _, d in prices})
    usable = {k: p for k, p in prices.items() if p > 0}
    everyone = {t for t, _ in usable} if universe is None else set(universe) | set(chosen)
    totals, units_by_day = {}, {}
    for sim in range(1, n_sims + 1):
        held = {t: (days[0], usable[t, days[0]], money / len(chosen) / usable[t, days[0]])
                for t in chosen if (t, days[0]) in usable}
        for day_idx, day in enumerate(days[1:], start=1):
            today = {t: p for (t, d), p in usable.items() if d == day}
            sales = []
            for ticker in sorted(held, key=key):
                why = ticker in today and reason(held[ticker][1], today[ticker], mode)
                choice = why and choose(seed, sim, day_idx, ticker, held, everyone, today)
                if choice:
                    sales.append((ticker, choice))
            after = dict(held)

            def buy(ticker, cash):
                old = after[ticker][2] if ticker in after else 0.0
                after[ticker] = (day, today[ticker], old + cash / today[ticker])

            if in_order:
                for ticker, choice in sales:
                    cash = after.pop(ticker)[2] * today[ticker]
                    buy(choice, cash)
            else:
                cash = [(choice, after.pop(ticker)[2] * today[ticker]) for ticker, choice in sales]
                for choice, amount in cash:
                    buy(choice, amount)
            held = after
            totals[sim, day] = sum(u * today.get(t, 0.0) for t, (_, _, u) in held.items())
            for ticker, (_, _, u) in held.items():
                units_by_day[sim, day, ticker] = u
    return totals, units_by_day
