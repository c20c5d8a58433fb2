"""Language ID rejects foreign Latin-script prose and random letters, and keeps clean short texts."""

import random

from conftest import DATA
from pyspark.sql import functions as F

from riskloom.llm import language_id

FOREIGN = [
    "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem.",
    "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto.",
    "Bütün insanlar hür, haysiyet ve haklar bakımından eşit doğarlar. Akıl ve vicdana sahiptirler.",
]


def test_rejection(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    model = language_id.fit(docs.where(~language_id.held_out()))
    r = random.Random(5)
    letters = ["".join(r.choice("abcdefghijklmnopqrstuvwxyz     ") for _ in range(n)) for n in (60, 400, 4000)]
    base64 = ["".join(r.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(n)) for n in (60, 4000)]
    _, score, accepted = model.predict(FOREIGN + [t * 20 for t in FOREIGN] + letters + base64)
    assert not accepted.any(), (score, model.radius)
    held = [x["text"] for x in docs.where(language_id.held_out() & F.col("lang").isNotNull() & (F.length("text") > 0)).collect()]
    assert model.predict(held)[2].all()
    assert model.predict([t[:40] for t in held])[2].mean() > 0.95
