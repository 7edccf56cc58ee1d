"""The rules of order-by-order books one event at a time: what the windows are held against."""

from tidebook.operators.orders import OBSERVED, SEEDED, UNKNOWN


class OrderBook:
    """A book of orders, empty or from a venue's list of orders."""

    def __init__(self) -> None:
        self.orders: dict[str, dict] = {}
        self.levels: dict[tuple[int, int], list[str]] = {}
        self.incomplete: set[tuple[int, int]] = set()

    def seed(self, orders: list[tuple[str, int, int, int]]) -> None:
        """Starts over from ``(id, side, price, qty)`` in queue order; what was ahead of the list is not known."""
        self.orders, self.levels = {}, {}
        for name, side, price, qty in orders:
            if qty > 0:
                self._rest(name, {"side": side, "price": price, "qty": qty, "executed": None, "certainty": SEEDED})

    def _rest(self, name: str, order: dict) -> None:
        self.orders[name] = order
        self.levels.setdefault((order["side"], order["price"]), []).append(name)

    def _leave(self, name: str) -> dict:
        order = self.orders.pop(name)
        level = (order["side"], order["price"])
        self.levels[level].remove(name)
        if not self.levels[level]:
            del self.levels[level]
            self.incomplete.discard(level)
        return order

    def best(self, side: int) -> int | None:
        prices = [p for s, p in self.levels if s == side]
        return (max(prices) if side == 0 else min(prices)) if prices else None

    def crossed(self) -> bool:
        bid, ask = self.best(0), self.best(1)
        return bid is not None and ask is not None and bid > ask

    def apply(self, action: str, name: str, side: int, price: int, qty: int, executed: int | None = None) -> tuple[str, int | None]:
        """(outcome, quantity traded)."""
        if qty < 0:
            return "negative", None
        old = self.orders.get(name)
        if action == "add":
            if old or not qty:
                return ("duplicate_add" if old else "empty"), None
            self._rest(name, {"side": side, "price": price, "qty": qty, "executed": executed, "certainty": OBSERVED})
            return "applied", None
        if not old:
            self.incomplete.add((side, price))
            return "unknown_order", None
        traded = max(executed - old["executed"], 0) if executed is not None and old["executed"] is not None else min(executed, old["qty"]) if executed is not None else old["qty"] if action == "execute" else 0
        if action != "modify":
            self._leave(name)
            return "applied", traded if action == "execute" else None
        new = old | {"side": side, "price": price, "qty": qty, "executed": old["executed"] if executed is None else executed}
        moved = (side, price) != (old["side"], old["price"])
        if moved or qty > old["qty"]:
            if not moved:
                new["certainty"] = UNKNOWN
            self._leave(name)
            self._rest(name, new)
        else:
            self.orders[name] = new
        if not qty:
            self._leave(name)
        return "applied", traded

    def position(self, name: str) -> tuple[int, int, int] | None:
        """(orders ahead, quantity ahead, certainty) of an order that rests."""
        if name not in self.orders:
            return None
        own = self.orders[name]
        level = (own["side"], own["price"])
        at = self.levels[level].index(name)
        ahead = [self.orders[x] for x in self.levels[level][:at]]
        sure = UNKNOWN if level in self.incomplete or own["certainty"] == UNKNOWN else next((x["certainty"] for x in ahead if x["certainty"] != OBSERVED), own["certainty"])
        return at, sum(x["qty"] for x in ahead), sure

    def prune_seeded(self) -> int:
        """Drops seeded orders from a touch that crosses, bids first, until it doesn't or only observed orders are left."""
        gone = 0
        while self.crossed():
            for level in ((0, self.best(0)), (1, self.best(1))):
                names = [n for n in self.levels[level] if self.orders[n]["certainty"] == SEEDED]
                if names:
                    for n in names:
                        self._leave(n)
                    gone += len(names)
                    break
            else:
                return gone
            if level in self.levels:
                return gone
        return gone
