"""The token registry: one token for each (category, value), the same in every run that starts from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import detectors as D
from .order import indexed

SCHEMA = "category string, norm string, original string, sanitized string, seq long"
#: Category precedence of a lookup without category (a fixed value).
PRECEDENCE = ("ipv4_priv", "ipv4_pub", "hostname", "fqdn", "username", "email", "sid", "aws_account", "arn", "org", "domain", "machine_account", "credential", "org_id", "agent_id")


def norm(column: Column) -> Column:
    return F.lower(F.trim(column))


def public_ip_token(seq: Column) -> Column:
    """Addresses of the three documentation ranges, then of 100.64.0.0/10, one for each number."""
    over = seq - 762
    far = F.concat_ws(".", F.lit("100"), (64 + F.floor(over / 65536)).cast("string"), F.pmod(F.floor(over / 256), F.lit(256)).cast("string"), F.pmod(over, F.lit(256)).cast("string"))
    return (
        F.when(seq <= 254, F.concat(F.lit("192.0.2."), seq.cast("string")))
        .when(seq <= 508, F.concat(F.lit("198.51.100."), (seq - 254).cast("string")))
        .when(seq <= 762, F.concat(F.lit("203.0.113."), (seq - 508).cast("string"))).otherwise(far)
    )


def hmac_sha256(secret: bytes, value: Column) -> Column:
    """HMAC by the built-in hash; the pads of the secret are computed once, here."""
    import hashlib

    key = (hashlib.sha256(secret).digest() if len(secret) > 64 else secret).ljust(64, b"\0")
    inner, outer = (bytes(b ^ p for b in key).hex() for p in (0x36, 0x5C))
    first = F.sha2(F.concat(F.unhex(F.lit(inner)), value.cast("binary")), 256)
    return F.sha2(F.concat(F.unhex(F.lit(outer)), F.unhex(first)), 256)


def private_ip_token(ip: Column, secret: bytes) -> Column:
    """An address of the same private block, read off a keyed hash of the address. Two addresses may get the same one."""
    mac = hmac_sha256(secret, ip)
    byte = lambda i: F.conv(F.substring(mac, 2 * i + 1, 2), 16, 10).cast("int")
    last = lambda i: F.greatest(F.lit(1), byte(i) % 255)
    join = lambda *x: F.concat_ws(".", *[(F.lit(v) if isinstance(v, str) else v.cast("string")) for v in x])
    return F.when(ip.startswith("172."), join("172", 16 + byte(0) % 16, byte(1), last(2))).when(ip.startswith("192.168."), join("192", "168", byte(0), last(1))).otherwise(join("10", byte(0), byte(1), last(2)))


ROUNDS = 4
#: Name, first address and half the bits of the private blocks (fixed values).
BLOCKS = (("10", 10 << 24, 12), ("172", (172 << 24) + (16 << 16), 10), ("192", (192 << 24) + (168 << 16), 8))


def permuted_ip_token(ip: Column, secret: bytes) -> Column:
    """Another address of the same private block, a different one for each address and never the address itself.

    A keyed Feistel network puts the block's addresses in a secret order; an address gets the next one in that order. Both
    halves of an address are as wide, so each block is permuted within itself, in one pass and without collisions.
    """
    number = F.split(ip, r"\.")
    whole = F.aggregate(F.transform(number, lambda x: x.cast("long")), F.lit(0).cast("long"), lambda a, x: a * 256 + x)
    kind = F.when(ip.startswith("10."), 0).when(ip.startswith("172."), 1).otherwise(2)
    pick = lambda i: F.element_at(F.array(*[F.lit(b[i]) for b in BLOCKS]), kind + 1)
    side = F.pow(F.lit(2), pick(2)).cast("long")
    div = lambda a, b: F.floor(a / b).cast("long")

    def mixed(half: Column, turn: Column) -> Column:
        mac = hmac_sha256(secret, F.concat_ws(":", pick(0), turn.cast("string"), half.cast("string")))
        return F.conv(F.substring(mac, 1, 8), 16, 10).cast("long") % side

    def turned(state: Column, turns: list[int], back: bool) -> Column:
        def one(x: Column, turn: Column) -> Column:
            left, right = x["l"], x["r"]
            return F.struct(right.bitwiseXOR(mixed(left, turn)).alias("l"), left.alias("r")) if back else F.struct(right.alias("l"), left.bitwiseXOR(mixed(right, turn)).alias("r"))

        return F.aggregate(F.array(*[F.lit(t) for t in turns]), state, one)

    halves = lambda n: F.struct(div(n, side).alias("l"), (n % side).alias("r"))
    # Each state is bound once, as the only item of an array, so that no expression is computed twice.
    bound = lambda value, then: F.element_at(F.transform(F.array(value), then), 1)
    turns = list(range(ROUNDS))
    ahead = bound(turned(halves(whole - pick(1)), turns, False), lambda x: halves((x["l"] * side + x["r"] + 1) % (side * side)))
    new = bound(turned(ahead, turns[::-1], True), lambda x: x["l"] * side + x["r"] + pick(1))
    return bound(new, lambda n: F.concat_ws(".", *[(div(n, F.lit(1 << s)) % 256).cast("string") for s in (24, 16, 8, 0)]))


def prefixed_ip_token(ip: Column, secret: bytes) -> Column:
    """Another address of the same private block that keeps networks: addresses with equal first octets get tokens with
    equal first octets. Each octet is permuted under a key of the octets before it; the block's own bits stay."""
    part = F.split(ip, r"\.")
    out = part[0]
    for i in (1, 2, 3):
        before, octet = F.array_join(F.slice(part, 1, i), "."), part[i].cast("long")
        # The order of all octets by their keyed hashes is a permutation; 172.16/12 keeps the upper half of its second octet.
        low, size = F.lit(0), F.lit(256)
        if i == 1:
            low = F.when(part[0] == "172", 16).when(part[0] == "192", 168).otherwise(0)
            size = F.when(part[0] == "172", 16).when(part[0] == "192", 1).otherwise(256)
        others = F.sequence(low, low + size - 1)
        hashed = F.transform(others, lambda o, before=before: F.struct(hmac_sha256(secret, F.concat_ws(".", before, o.cast("string"))).alias("h"), o.alias("o")))
        ordered = F.transform(F.array_sort(hashed), lambda x: x["o"])
        out = F.concat_ws(".", out, F.element_at(ordered, (octet - low + 1).cast("int")).cast("string"))
    return out


def token(category: Column, original: Column, seq: Column, secret: bytes, networks: bool = False) -> Column:
    number = lambda form: F.format_string(form, seq)
    forms = {
        "org": "ORG-%04d", "domain": "domain-%04d.example.net", "hostname": "HOST-%04d", "fqdn": "host-%04d.example.internal", "username": "USER-%04d",
        "email": "user-%04d@example.net", "sid": "S-1-5-21-1000000000-2000000000-3000000000-%04d", "machine_account": "MACHINE-%04d$", "credential": "CRED-%04d", "agent_id": "AGENT-%04d",
    }
    mapped = prefixed_ip_token if networks else permuted_ip_token
    private = F.when(category == "ipv4_priv", original)
    real = private.rlike(f"^(?:{D.IPV4})$") & D.is_private_ip(private)
    out = F.when(category == "ipv4_priv", F.when(real, mapped(F.when(real, private), secret)).otherwise(private_ip_token(private, secret))).when(category == "ipv4_pub", public_ip_token(seq))
    for name, form in forms.items():
        out = out.when(category == name, number(form))
    account = (F.lit(100000000000) + seq).cast("string")
    out = out.when(category == "aws_account", account).when(category == "arn", F.concat(F.lit("arn:aws:iam::"), account, F.lit(":sanitized/"), seq.cast("string")))
    return out.when(category == "org_id", (seq + 10000).cast("string")).otherwise(F.concat(F.lit("REDACTED-"), F.upper(category), F.lit("-"), number("%04d")))


def grow_registry(registry: DataFrame, candidates: DataFrame, secret: bytes = b"secret", order: tuple[str, ...] = ("record_id", "start"), networks: bool = False) -> DataFrame:
    """The registry with what candidates (category, value, and the columns in ``order``) bring that is new.

    A value keeps its first spelling. Numbers go on from each category's last, in order of value, so they don't depend on
    arrival; entries that exist keep theirs. Places in the order come from ranges of values, so no category is ranked in
    one task. Private addresses are permuted within their block; with ``networks``, octet by octet.
    """
    seen = candidates.filter(F.col("value").isNotNull() & (F.trim("value") != "")).groupBy("category", norm(F.col("value")).alias("norm")).agg(F.min_by("value", F.struct(*order)).alias("original"))
    new = indexed(seen.join(registry.select("category", "norm"), ["category", "norm"], "left_anti"), ["category", "norm"])
    bounds = new.groupBy("category").agg(F.min("__index").alias("low")).join(registry.groupBy("category").agg(F.max("seq").alias("last")), "category", "left")
    numbered = new.join(F.broadcast(bounds), "category")  # one row a category
    numbered = numbered.withColumn("seq", (F.coalesce("last", F.lit(0)) + F.col("__index") - F.col("low") + 1).cast("long"))
    tokens = numbered.select("category", "norm", "original", token(F.col("category"), F.trim("original"), F.col("seq"), secret, networks).alias("sanitized"), "seq")
    return registry.select("category", "norm", "original", "sanitized", "seq").unionByName(tokens)


def resolve(spans: DataFrame, registry: DataFrame) -> DataFrame:
    """Spans with their token."""
    return spans.withColumn("norm", norm(F.col("value"))).join(registry.select("category", "norm", F.col("sanitized").alias("token")), ["category", "norm"], "left")


def resolve_any(values: DataFrame, registry: DataFrame, column: str = "value") -> DataFrame:
    """Tokens of values of unknown category: that of the first category that has the value."""
    rank = F.array_position(F.array(*[F.lit(c) for c in PRECEDENCE]), F.col("category"))
    first = registry.groupBy("norm").agg(F.min_by("sanitized", F.when(rank == 0, 99).otherwise(rank)).alias("token"))
    return values.withColumn("norm", norm(F.col(column))).join(first, "norm", "left")


def collisions(registry: DataFrame) -> DataFrame:
    """Tokens that stand for more than one value."""
    return registry.groupBy("sanitized").agg(F.count_distinct("norm").alias("n_originals")).filter("n_originals > 1")


def stats(registry: DataFrame) -> DataFrame:
    return registry.rollup("category").agg(F.count("*").alias("n"))
