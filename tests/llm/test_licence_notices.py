"""Licence notices as files hold them: wrapped, and several together."""

import pytest

from orbitframe.llm import licences

WRAPPED = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights""",
    "GPL": """# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation, either version 3 of the License, or""",
    "BSD": """ * Redistribution and use in source and binary forms, with or without
 * modification, are permitted provided that the following conditions are met:""",
}


@pytest.fixture(scope="module")
def model():
    return licences.fit()


@pytest.mark.parametrize("family", WRAPPED)
def test_wrapped_notices(model, family):
    notice = WRAPPED[family]
    for text in (notice, notice.replace("\n", "\r\n"), f"İİ onen eau\n\n{notice}\n\nschen lor\n"):
        (start, end, found, _), *more = licences.spans(text, model)
        assert found == family and not more
        assert text[start:].split()[0] in notice.split()[:3] and "\n" in text[start:end]


DUAL = [
    ("Released under the MIT License. Licensed under the Apache License, Version 2.0.", "Apache MIT"),
    ("Licensed under CC BY 4.0. Licensed under the BSD 3-Clause License. Released under the GNU GPL version 2 or later.", "BSD CC-BY GPL"),
    (f"{WRAPPED['MIT']}\n{WRAPPED['BSD']}", "BSD MIT"),
    ("This work is licensed under the GNU General Public License, version 3. Licensed under the GNU Affero General Public License, version 3.", "AGPL GPL"),
]


@pytest.mark.parametrize("text, families", DUAL)
def test_notices_side_by_side(model, text, families):
    assert " ".join(sorted(s[2] for s in licences.spans(text, model))) == families


def test_every_two_templates(model):
    every = [(f, t) for f, ts in licences.TEMPLATES.items() for t in ts]
    for f, a in every:
        for g, b in every:
            assert {s[2] for s in licences.spans(f"{a} {b}", model)} == {f, g}, (a, b)


#: Openings of notices as their texts have them, wrapped; not the templates' wording throughout.
OPENINGS = {
    "Apache": '''/*
 * Licensed under the Apache License, Version 2.0 (the "License");
 * you may not use this file except in compliance with the License.
 * You may obtain a copy of the License at
 */''',
    "LGPL": """ * This library is free software; you can redistribute it and/or
 * modify it under the terms of the GNU Lesser General Public
 * License as published by the Free Software Foundation; either
 * version 2.1 of the License, or (at your option) any later version.""",
    "AGPL": """# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU Affero General Public License as
# published by the Free Software Foundation, either version 3 of the
# License, or (at your option) any later version.""",
    "MPL": """// This Source Code Form is subject to the terms of the Mozilla Public
// License, v. 2.0. If a copy of the MPL was not distributed with this
// file, You can obtain one at the usual place.""",
    "CC-BY-SA": """This work is licensed under a Creative Commons
Attribution-ShareAlike 4.0 International License.""",
    "PublicDomain": """This is free and unencumbered software released
into the public domain.""",
}


@pytest.mark.parametrize("family", OPENINGS)
def test_openings_are_found(model, family):
    assert {s[2] for s in licences.spans(f"onen eau\n{OPENINGS[family]}\n\nschen lor", model)} == {family}


def test_tags_are_found(model):
    for family, tags in licences.TAGS.items():
        for tag in tags:
            text = f"// SPDX-License-Identifier: {tag}\nint main() {{}}\n"
            assert {s[2] for s in licences.spans(text, model)} == {family}, tag
    assert licences.spans("SPDX-License-Identifier: LicenseRef-Other-9.9", model) == []
