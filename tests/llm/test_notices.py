"""Published licence notices, as they are wrapped and commented."""

import pytest

from churnlake.llm import license_scan

MIT = """MIT License
Copyright (c) 2020 X

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY."""
GPL = """Copyright (C) 2020  X

This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details."""
BSD = """Copyright (c) 2020, X

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission."""
APACHE = """Copyright 2020 X

Licensed under the Apache License, Version 2.0 (the "License"); you may not
use this file except in compliance with the License. You may obtain a copy of
the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS."""
RULES = {"mit-full": MIT, "gpl3-header": GPL, "bsd-3": BSD, "apache-header": APACHE,
         "mit-full-titled": MIT.replace("MIT License", "The MIT License")}


@pytest.mark.parametrize("first,each,last", [
    ("", "", ""), ("", "# ", ""), ("", "// ", ""), ("/*\n", " * ", "\n */"), ("", "; ", ""), ("", "! ", ""), ("<!--\n", "", "\n-->")])
def test_published_notices(spark, first, each, last):
    rows = []
    for end in ("\n", "\r\n"):
        for rule, text in RULES.items():
            lines = [(each + line).rstrip() for line in text.split("\n")]
            rows.append((rule, (first + "\n".join(lines) + last + "\n\nint main() {}").replace("\n", end)))
    found = license_scan.scan(spark.createDataFrame(rows, "doc_id string, text string")).collect()
    assert sorted((r.doc_id, r.rule) for r in found) == sorted((r, r) for r in [*RULES, *RULES])
