import itertools
import math

from builders import clock, purchase, raw, raw_row

from clickloom import SQL
from clickloom.operators import funnel, multi_touch, upkeep
from clickloom.operators.attribution import attribute_events
from clickloom.operators.carts import abandoned_carts
from clickloom.operators.normalize import stage_events
from clickloom.plans.catalog import QUERIES
from clickloom.plans.sample_events import raw_events

GOOGLE, MAIL = "https://google.com", "?utm_medium=email"


def journeys(spark):
    rows = [
        raw_row("a", clock(), referrer=GOOGLE),
        raw_row("a", clock(days=2), path=MAIL),
        purchase("a", clock(days=4), "T1", 90.0),
        raw_row("b", clock(), path=MAIL),
        purchase("b", clock(minutes=5), "T2", 40.0, GOOGLE),
        purchase("c", clock(), "T3", 10.0),
    ]
    return multi_touch.touch_paths(stage_events(raw(spark, rows)))


def test_linear_and_decayed_credit(spark):
    paths = journeys(spark).cache()
    linear = {(r.transaction_id, r.channel): r.credit for r in multi_touch.spread_credit(paths).collect()}
    assert linear == {
        ("T1", "Organic Search"): 30.0, ("T1", "Email"): 30.0, ("T1", "Direct"): 30.0,
        ("T2", "Email"): 40.0, ("T3", "Direct"): 10.0,
    }
    decayed = {r.channel: r.weight for r in multi_touch.spread_credit(paths, "time_decay", 2.0).where("transaction_id = 'T1'").collect()}
    for channel, weight in {"Organic Search": 1 / 7, "Email": 2 / 7, "Direct": 4 / 7}.items():
        assert math.isclose(decayed[channel], weight)


def test_shapley_against_all_orders(spark):
    paths = journeys(spark)
    conversions = [(set(t.first_channel for t in r.path), r.revenue) for r in paths.collect()]
    players = sorted(set().union(*[c for c, _ in conversions]))

    def worth(coalition):
        return sum(revenue for channels, revenue in conversions if channels <= coalition)

    expected = dict.fromkeys(players, 0.0)
    orders = list(itertools.permutations(players))
    for order in orders:
        for i, player in enumerate(order):
            expected[player] += (worth(set(order[: i + 1])) - worth(set(order[:i]))) / len(orders)
    found = {r.channel: r.value for r in multi_touch.shapley_values(paths).collect()}
    assert found.keys() == expected.keys()
    assert all(math.isclose(found[p], expected[p]) for p in players)


def test_incremental_attribution_of_a_cut_session(spark):
    # The session runs across the cut and its true start is outside every window.
    bot = [raw_row("bot", clock(minutes=20 * i), referrer=GOOGLE) for i in range(12 * 72)]
    rows = [*bot, purchase("bot", clock(days=10, minutes=1), "T", 5), purchase("u", clock(days=10), "T2", 1)]
    staged = stage_events(raw(spark, rows))
    found = {r.transaction_id: r.first_click_channel for r in upkeep.attribute_since(staged, "2025-01-10").collect()}
    assert found == {"T": "Direct", "T2": "Direct"}


def test_write_back_of_a_moved_transaction(spark):
    rows = [purchase("u", clock(days=3), "T", 5), purchase("v", clock(days=4), "T2", 1), purchase("u", clock(days=11), "T", 2)]
    staged, since = stage_events(raw(spark, rows)), "2025-01-10"
    old = attribute_events(staged.where("event_ts < '2025-01-10'"))
    fresh = upkeep.attribute_since(staged, since)
    merged = upkeep.merged_gold(old, fresh, since).collect()
    assert sorted(merged) == sorted(attribute_events(staged).collect()) and len(merged) == 2
    assert [r.transaction_id for r in upkeep.moved(old, fresh, since).collect()] == ["T"]
    assert upkeep.stale_days(old, fresh, since).collect() == old.where("transaction_id = 'T'").selectExpr("to_date(conversion_time)").collect()


def test_abandoned_cart_boundary(spark):
    cart = lambda user, **at: raw_row(user, clock(**at), "product_added_to_cart")
    rows = [
        cart("in time"), purchase("in time", clock(minutes=60), "T", 1),
        cart("late"), purchase("late", clock(minutes=60, microseconds=1), "T", 1),
        cart("twice"), cart("twice", minutes=45), raw_row("twice", clock(minutes=50)),
        cart("never", minutes=7),
    ]
    found = sorted((r.user_id, r.cart_ts.minute) for r in abandoned_carts(stage_events(raw(spark, rows))).collect())
    assert found == [("late", 0), ("never", 7), ("twice", 45)]


def test_ordered_funnel(spark):
    steps = ("a", "b", "c")
    rows = [raw_row("u", clock(minutes=m), n) for m, n in enumerate("abc")]
    rows += [raw_row("v", clock(minutes=m), n) for m, n in enumerate("cba")]
    rows += [raw_row("w", clock(minutes=m), n) for m, n in enumerate("bab")]
    found = {r.step: r.users for r in funnel.ordered_funnel(stage_events(raw(spark, rows)), steps).collect()}
    assert found == {"a": 3, "b": 2, "c": 1}


def test_masking_leaves_no_address(spark):
    rows = [raw_row("u", clock(), payload='{"mail":"jo.doe@example.org","card":"4111111111111111"}')]
    masked = upkeep.masked(raw(spark, rows), "salt").first()
    assert masked.event_data == '{"mail":"<email>","card":"<number>"}'
    assert len(masked.client_id) == 64 and masked.clientId is None


def test_credit_adds_up(spark, sf_dir):
    staged = stage_events(raw_events(spark, sf_dir))
    paths = multi_touch.touch_paths(staged, SQL)
    weights = multi_touch.spread_credit(paths).groupBy("transaction_id", "user_id").sum("weight").collect()
    assert len(weights) == paths.count() and all(math.isclose(r[2], 1.0) for r in weights)


def test_every_inventory_section_is_registered():
    prefixes = {name.split("_")[0] for name in QUERIES}
    expected = {
        "s": set(range(1, 17)) - {15}, "p": range(1, 16), "c": range(1, 4), "f": range(1, 31), "j": range(1, 6),
        "a": range(1, 27), "w": range(1, 9), "o": range(1, 9), "q": range(1, 10), "r": range(1, 15), "m": range(13),
        "d": range(1, 7), "n": range(1, 11), "v": range(1, 12), "st": range(1, 7), "x": range(1, 17),
    }
    missing = [f"{k}{i}" for k, ids in expected.items() for i in ids if f"{k}{i}" not in prefixes]
    assert missing == []
    assert {f"t{c}" for c in "abcdefghiz"} <= prefixes
