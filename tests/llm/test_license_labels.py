"""Labels of known texts: each license gives its label and no other."""

import pytest

from genoeval.llm import licenses

BSD = (
    "Copyright (c) 2020, Someone. All rights reserved. Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
    "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. "
)
PROVIDED = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES ARE DISCLAIMED."
NOTICE = "This program is free software; you can redistribute it and/or modify it under the terms of the GNU {} as published by the Free Software Foundation{} either version {} of the License, or (at your option) any later version. You should have received a copy of the GNU {} along with this program."
GPL, LGPL, AGPL = "General Public License", "Lesser General Public License", "Affero General Public License"
# text, the method's labels
TEXTS = [
    (BSD + PROVIDED, "bsd-2-clause"),
    (BSD + "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software. " + PROVIDED, "bsd-3-clause"),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software. The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY", "mit"),
    ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice appear. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE", "isc"),
    ("Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that", "isc"),
    ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.", "0bsd"),
    (NOTICE.format(GPL, ";", "2", GPL), "gpl-2.0"), (NOTICE.format(GPL, ",", "3", GPL), "gpl-3.0"), (NOTICE.format(LGPL, ";", "2.1", LGPL), "lgpl-2.1"),
    (NOTICE.format(LGPL, ",", "3", LGPL), "lgpl-3.0"), (NOTICE.format(AGPL, ",", "3", AGPL), "agpl-3.0"),
    ("Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. http://www.apache.org/licenses/LICENSE-2.0", "apache-2.0"),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed", "mpl-2.0"),
    ("The contents of this file are subject to the Mozilla Public License Version 1.1 (the License)", "mpl-1.1"), ("under mpl 1.1", "mpl-1.1"), ("the MPL", "mpl"),
    ("the Eclipse Public License", "epl"), ("the Eclipse Public License 2.0", "epl-2.0"),
    ("This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software", "unlicense"),
    ("This software is provided 'as-is', without any express or implied warranty. The origin of this software must not be misrepresented; Altered source versions must be plainly marked as such", "zlib"),
    ("This work is licensed under a Creative Commons Attribution 4.0 International License.", "cc-by"),
    ("SPDX-License-Identifier: MIT OR Apache-2.0", "apache-2.0,mit"), ("// SPDX-License-Identifier: (GPL-2.0-only WITH Classpath-exception-2.0) AND BSD-3-Clause", "bsd-3-clause,gpl-2.0,gpl-classpath"),
    ("SPDX-License-Identifier: LGPL-2.0", "lgpl-2.0"), ("# SPDX-License-Identifier: ISC.\nunrelated mit", "isc"), ("SPDX-License-Identifier: Apache-2.0 WITH LLVM-exception", "apache-2.0,llvm-exception"),
    ("Copyright 2001 Someone. All rights reserved.", "all-rights-reserved"),
]


@pytest.mark.parametrize("text,labels", TEXTS)
def test_labels(text, labels):
    found = licenses.specific({d[2] for d in licenses.detect(text.lower().encode())})
    assert ",".join(sorted(found)) == labels


def test_base_labels_stay(spark):
    docs = spark.createDataFrame([(1, NOTICE.format(GPL, ",", "3", GPL)), (2, "Apache License, Version 2.0, MIT license")], "doc_id long, text string")
    got = {r["doc_id"]: (r["base_labels"], r["labels"]) for r in licenses.scan_licenses(docs).collect()}
    assert got == {1: ("gpl", "gpl,gpl-3.0"), 2: ("apache,mit", "apache,apache-2.0,mit")}
