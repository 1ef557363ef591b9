"""A turn-based simulation over tables: provinces (k, owner, core, pop, ...), countries, wars and alliances as edge tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from terrane.operators.graph import cut

#: A province's yield, an occupied province's share of it, what an economy level adds; recruits by people, of
#: provinces of another core, and the turns of recruits that are stored; the upkeep of a division.
INCOME, OCCUPIED, STEP = 0.1, 0.5, 0.25
MANPOWER, FOREIGN, STORED = 1e-7, 0.25, 12
UPKEEP = 0.15


def province_income() -> Column:
    """From pop, gdppc, bonus, econ, core and owner."""
    base = F.col("pop") * F.col("gdppc") / 1e9 * INCOME * (1 + F.col("bonus")) * (1 + STEP * F.col("econ"))
    return F.when(F.col("core") == F.col("owner"), base).otherwise(base * OCCUPIED)


def economy(provinces: DataFrame) -> DataFrame:
    """owner, income, army, recruits, and provinces held, in one pass."""
    people = F.col("pop") * F.when(F.col("core") == F.col("owner"), 1.0).otherwise(FOREIGN)
    return provinces.groupBy("owner").agg(F.sum(province_income()).alias("income"), F.sum("army").alias("army"), (F.sum(people) * MANPOWER).alias("recruits"), F.count(F.lit(1)).alias("held"))


def war_scores(provinces: DataFrame, countries: DataFrame, wars: DataFrame) -> DataFrame:
    """a, b, since, score: of each war the people that a holds of b's core less those that b holds of a's, over the smaller
    of the two start populations, between -1 and 1. Only provinces that changed hands are grouped."""
    taken = provinces.where("owner <> core").groupBy("owner", "core").agg(F.sum("pop").alias("people"))
    side = lambda a, b, out: taken.select(F.col("owner").alias(a), F.col("core").alias(b), F.col("people").alias(out))
    both = wars.join(side("a", "b", "gain"), ["a", "b"], "left").join(side("b", "a", "loss"), ["a", "b"], "left")
    start = lambda c, out: countries.select(F.col("id").alias(c), F.col("start_pop").alias(out))
    both = both.join(start("a", "pa"), "a").join(start("b", "pb"), "b")
    raw = (F.coalesce("gain", F.lit(0)) - F.coalesce("loss", F.lit(0))) / F.greatest(F.lit(1), F.least("pa", "pb"))
    return both.select("a", "b", "since", F.greatest(F.lit(-1.0), F.least(F.lit(1.0), raw)).alias("score"))


def accepts_peace(score: Column, turns: Column, of_the_date: Column, contested: Column) -> Column:
    """Whether the first side of a war agrees to end it."""
    return ~contested & (F.when(score < -0.3, True).when(of_the_date, (score < -0.12) & (turns > 6)).when(turns < 4, False).otherwise((score < 0.08) | ((score < 0.3) & (turns > 18))))


def enemies_of_enemies(wars: DataFrame, allies: DataFrame) -> DataFrame:
    """a, x, common: countries x that fight a common enemy with a and aren't its allies or enemies; edges hold for both sides."""
    both = lambda t: t.select("a", "b").unionByName(t.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    w, friends = both(wars), both(allies)
    met = w.join(w.select(F.col("b").alias("b"), F.col("a").alias("x")), "b").where("a <> x").groupBy("a", "x").agg(F.count(F.lit(1)).alias("common"))
    for t in (w, friends):
        met = met.join(t.select("a", F.col("b").alias("x")), ["a", "x"], "left_anti")
    return met


def turn(provinces: DataFrame, countries: DataFrame) -> DataFrame:
    """countries (id, gold, manpower, ...) after a turn: income less upkeep, recruits up to their cap; one that cannot pay is
    broke and has no gold; one without provinces is out."""
    t = economy(provinces)
    c = countries.join(t, F.col("id") == F.col("owner"), "left").na.fill(0, ["income", "army", "recruits", "held"])
    left = F.col("gold") + F.col("income") - UPKEEP * F.col("army")
    return c.select("id", F.greatest(F.lit(0.0), left).alias("gold"), F.least(F.col("manpower") + F.col("recruits"), STORED * F.col("recruits")).alias("manpower"), (left < 0).alias("broke"), (F.col("held") > 0).alias("alive"))


def disband(provinces: DataFrame, countries: DataFrame) -> DataFrame:
    """Provinces after broke countries sent 3 % of their armies home, rounded up: province by province in order of k, at most
    5 % of each, rounded up, from those with more than one division."""
    broke = countries.where("broke").select(F.col("id").alias("owner"), F.lit(True).alias("broke"))
    w = Window.partitionBy("owner")
    gives = F.when(F.col("broke") & (F.col("army") > 1), F.ceil(F.col("army") * 0.05)).otherwise(0)
    before = F.coalesce(F.sum(gives).over(w.orderBy("k").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cut_ = F.ceil(F.sum("army").over(w) * 0.03)
    lost = F.greatest(F.lit(0), F.least(gives, cut_ - before))
    return provinces.join(F.broadcast(broke), "owner", "left").withColumn("_left", (F.col("army") - lost).cast("long")).drop("army", "broke").withColumnRenamed("_left", "army")


def paths(edges: DataFrame, provinces: DataFrame, start: int, owner: int) -> DataFrame:
    """node, n_steps, path: shortest ways from a start through the owner's provinces, whose last step may enter another's; of
    equally short ones the smallest by node numbers. Each round's frontier is one row a node."""
    own = provinces.select(F.col("k").alias("node"), (F.col("owner") == owner).alias("own"))
    seen = cut(own.where(F.col("node") == start).select("node", "own", F.lit(0).alias("n_steps"), F.array("node").alias("path")))
    frontier = seen
    while frontier.take(1):
        step = frontier.where((F.col("own")) | (F.col("n_steps") == 0)).select(F.col("node").alias("src"), "n_steps", "path").join(edges, "src")
        step = step.groupBy(F.col("dst").alias("node")).agg(F.min(F.struct("path", "n_steps")).alias("p")).join(seen.select("node"), "node", "left_anti")
        frontier = cut(step.join(own, "node").select("node", "own", (F.col("p.n_steps") + 1).alias("n_steps"), F.concat("p.path", F.array("node")).alias("path")))
        seen = cut(seen.unionByName(frontier))
    return seen.select("node", "n_steps", "path")
