LONG = " ".join(f"word{i % 997} of{i % 89}" for i in range(30_000))
PASSAGE = " ".join(f"shared{i} passage{i * 7 % 31}" for i in range(40))
