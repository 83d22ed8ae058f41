import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from promptwatt.session import get_session
    s = get_session("local[4]", shuffle_partitions=8)
    yield s


PROMPTS = [
    ("simple", "Hello, how are you?"),
    ("medium", "Explain the concept of machine learning and how it can be used in real-world applications."),
    ("complex", "Design a comprehensive distributed system architecture for a global e-commerce platform.\n"
                "Consider   scalability, fault tolerance, and data consistency.\n"
                "Explain how you would handle 1. caching 2. sharding, and compare the trade-offs.\n"
                "Why would a neural network model help with fraud analysis?"),
    ("verbose", "In order to provide you with the best answer, I would like to basically take into "
                "consideration all of the various different factors that are really important."),
    ("technical", "Analyze the multi-layer perceptron architecture, discussing how backpropagation enables "
                  "gradient-based optimization of neural network parameters."),
    ("empty", ""),
    ("whitespace", "   "),
    ("single_word", "Hello"),
    ("long", "word " * 500),
    ("unicode", "Hello, 你好, مرحبا, Привет!"),
    ("special_chars", "Hello! @#$%^&*() How are you?"),
]


@pytest.fixture(scope="session")
def prompts(spark):
    return spark.createDataFrame(PROMPTS, "name string, text string")
