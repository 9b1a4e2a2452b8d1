from siteledger.llm.pii import personal_data


def test_one_side_is_enough(frame):
    # Words on the other side vary, and common ones stand beside other numbers as well.
    rows = [(i, f"Please call +1 (555) 010-{i:04d} {'today or soon' if i % 2 else f'word{chr(97 + i % 26)} now'}.") for i in range(100)]
    rows += [(500 + i, f"We sold 55512{i:05d} today and made more.") for i in range(100)]
    rows += [(700 + i, f"word{chr(97 + i % 26)} person{i % 7}@mail.example wrote this.") for i in range(60)]
    rows += [
        (1000, "Please call 555-010-9999 whenever."), (1001, "Please call 555-010-9998 today."), (1002, "They sold 555-010-9995 whenever."),
        (1003, "Then boss@intranet wrote this."), (1004, "Then boss@outside sold this."),
    ]
    found = {r["doc_id"]: r["spans"] for r in personal_data(frame(rows)).collect()}
    want = {1000: "phone:12:24", 1001: "phone:12:24", 1002: "", 1003: "email:5:18", 1004: ""}
    assert {i: found[i] for i in want} == want
    assert not any(found[500 + i] for i in range(100))
