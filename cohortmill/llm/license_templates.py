"""Licence texts and notices as templates. All values here are fixed: public licence wording and its markup.

``[[ ... ]]`` is optional wording; ``<<n>>`` is a replaceable region of at most n words (names, years, versions).
Words are compared without case and punctuation.
"""

import itertools

TEMPLATES = {
    "mit": """
        Permission is hereby granted, free of charge, to any person obtaining a copy of <<12>> and associated documentation
        files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use,
        copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to
        whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this
        permission notice [[(including the next paragraph)]] shall be included in all copies or substantial portions of the
        Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
        LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL
        <<20>> BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
        ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE""",
    "isc": """
        Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS
        PROVIDED "AS IS" AND <<12>> DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
        MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL <<12>> BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL
        DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
        NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE""",
    "bsd-2-clause": """
        Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
        following conditions are met: [[1.]] Redistributions of source code must retain the above copyright notice, this list
        of conditions and the following disclaimer. [[2.]] Redistributions in binary form must reproduce the above copyright
        notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided
        with the distribution. THIS SOFTWARE IS PROVIDED BY <<20>> "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING,
        BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED""",
    "bsd-3-clause": """
        Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
        following conditions are met: [[1.]] Redistributions of source code must retain the above copyright notice, this list
        of conditions and the following disclaimer. [[2.]] Redistributions in binary form must reproduce the above copyright
        notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided
        with the distribution. [[3.]] Neither the name of <<20>> may be used to endorse or promote products derived from this
        software without specific prior written permission""",
    "zlib": """
        This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held
        liable for any damages arising from the use of this software. Permission is granted to anyone to use this software
        for any purpose, including commercial applications, and to alter it and redistribute it freely""",
    "boost": """
        Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and
        accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute,
        and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the
        Software is furnished to do so, all subject to the following""",
    "unlicense": """
        This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use,
        compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose,
        commercial or non-commercial, and by any means""",
    "apache-2.0": """
        Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with
        the License. You may obtain a copy of the License at [[http://www.apache.org/licenses/LICENSE-2.0]]
        [[https://www.apache.org/licenses/LICENSE-2.0]] Unless required by applicable law or agreed to in writing, software
        distributed under the License is distributed on an "AS IS" BASIS""",
    "gpl-notice": """
        This program is free software[[: you]][[; you]] can redistribute it and/or modify it under the terms of the GNU
        General Public License as published by the Free Software Foundation, either version <<1>> of the License, or (at your
        option) any later version""",
    "mit-notice": "released under the [[terms of the]] MIT License",
    "apache-notice": "Licensed under the [[terms of the]] Apache License [[, Version <<2>>]]",
    "cc0": "licensed under [[a]] [[the]] CC0 <<2>>",
}

# Labels of several templates of one licence family.
LABELS = {"mit-notice": "mit", "apache-notice": "apache", "gpl-notice": "gpl"}

# Notices: what they name. They begin at "under", so any verb (released, licensed, distributed, available ...) or none may stand before.
TERMS = "under [[the terms of]] [[the terms and conditions of]] [[the conditions of]] [[the]] [[a]] [[an]]"
_GNU = "[[version <<2>> of the]] [[GNU]]"
_CC_LICENSE = "[[Public]] [[International]] [[Unported]] [[Generic]] License"
NOTICES = {
    "mit": ["MIT License", "MIT/X11 License", "MIT (X11) License", "Expat License"],
    "apache": ["Apache [[Software]] License", "Apache 2.0"],
    "gpl": [f"{_GNU} General Public License", "GNU GPL", "GPL [[version]] [[v]] 2", "GPL [[version]] [[v]] 3", "GPLv2", "GPLv3"],
    "lgpl": [f"{_GNU} Lesser General Public License", f"{_GNU} Library General Public License", "[[GNU]] LGPL"],
    "agpl": [f"{_GNU} Affero General Public License", "[[GNU]] AGPL"],
    "mpl": ["Mozilla Public License", "MPL"],
    "epl": ["Eclipse Public License", "EPL"],
    "cc0": ["[[Creative Commons]] CC0", "Creative Commons Zero"],
    "boost": ["Boost Software License", "Boost License"],
    "bsd": ["[[New]] [[Modified]] [[Revised]] [[Simplified]] [[FreeBSD]] BSD [[style]] License"],
    "bsd-2-clause": ["2-Clause BSD", "two-clause BSD", "BSD 2-Clause", "BSD two-clause"],
    "bsd-3-clause": ["3-Clause BSD", "three-clause BSD", "BSD 3-Clause", "BSD three-clause"],
}

# Creative Commons: the parts of the name, short and spelled out; a version or the word "License" ends it, so that no name is
# taken for a longer one.
_CC_PARTS = {"by": ["Attribution"], "nc": ["NonCommercial", "Non-Commercial"], "sa": ["ShareAlike", "Share-Alike", "Share Alike"],
             "nd": ["NoDerivatives", "NoDerivs", "No-Derivatives", "No-Derivs"]}
_CC_VERSIONS = ["[[1]] [[2]] [[3]] [[4]] [[5]] 0", "2.1", "2.5"]
_CC_DIGITS = "[[1]] [[2]] [[3]] [[4]] [[5]] [[0]] [[1]] [[5]]"
for _kind in ("by", "by-sa", "by-nd", "by-nc", "by-nc-sa", "by-nc-nd"):
    _spelled = list(itertools.product(*(_CC_PARTS[part] for part in _kind.split("-"))))
    _names = [f"[[Creative Commons]] CC {_kind}", *(f"Creative Commons {' '.join(names)}" for names in _spelled)]
    NOTICES["cc-" + _kind] = [f"{name} {end}" for name in _names for end in (*_CC_VERSIONS, f"{_CC_DIGITS} {_CC_LICENSE}")]

# Headers of files.
_FREE = "is free software [[: you]] [[you]] can redistribute it and/or modify it under the terms of the [[version <<2>> of the]] GNU"
_FSF = "General Public License [[version <<2>>]] as published by the Free Software Foundation"
HEADERS = {
    "gpl": [f"{_FREE} {_FSF}"],
    "lgpl": [f"{_FREE} Lesser {_FSF}", f"{_FREE} Library {_FSF}"],
    "agpl": [f"{_FREE} Affero {_FSF}"],
    "mpl": ["This Source Code Form is subject to the terms of the Mozilla Public License",
            "The contents of this file are subject to the Mozilla Public License"],
    "epl": ["This program and the accompanying materials are made available under the terms of the Eclipse Public License",
            "The contents of this file are subject to the Eclipse Public License"],
    "apache": ["Licensed to the Apache Software Foundation (ASF) under one or more contributor license agreements"],
}

# The headings by which the long licence texts begin.
_GPL_HEADING = "General Public License Version <<5>> Copyright <<5>> Free Software Foundation"
HEADINGS = {
    "apache": ["Apache License Version 2.0, January 2004 [[http://www.apache.org/licenses/]] [[https://www.apache.org/licenses/]] "
               "TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION"],
    "gpl": [f"GNU {_GPL_HEADING}"],
    "lgpl": [f"GNU Lesser {_GPL_HEADING}", f"GNU Library {_GPL_HEADING}"],
    "agpl": [f"GNU Affero {_GPL_HEADING}"],
    "mpl": ["Mozilla Public License Version <<2>> 1. Definitions"],
    "epl": ["THE ACCOMPANYING PROGRAM IS PROVIDED UNDER THE TERMS OF THIS ECLIPSE PUBLIC LICENSE"],
}

# Licence identifiers in file headers, by label; versions and endings such as "or-later" need not follow.
IDENTIFIERS = {
    "mit": "MIT", "apache": "Apache", "gpl": "GPL", "lgpl": "LGPL", "agpl": "AGPL", "mpl": "MPL", "epl": "EPL", "isc": "ISC",
    "zlib": "Zlib", "unlicense": "Unlicense", "boost": "BSL-1.0", "cc0": "CC0", "bsd-2-clause": "BSD-2-Clause",
    "bsd-3-clause": "BSD-3-Clause", "cc-by-sa": "CC-BY-SA", "cc-by-nd": "CC-BY-ND",
    "cc-by-nc-sa": "CC-BY-NC-SA", "cc-by-nc-nd": "CC-BY-NC-ND",
    # Names that longer ones begin with need the end of their version.
    "cc-by": "CC-BY-[[1]] [[2]] [[3]] [[4]] 0", "cc-by-nc": "CC-BY-NC-[[1]] [[2]] [[3]] [[4]] 0",
}
# An identifier stands first, or behind an operator of the expression.
SPDX = ("SPDX-License-Identifier: {}", "SPDX-License-Identifier: <<6>> OR {}", "SPDX-License-Identifier: <<6>> AND {}")

for _label, _names in NOTICES.items():
    for _n, _name in enumerate(_names):
        TEMPLATES[f"{_label}/notice/{_n}"] = f"{TERMS} {_name}"
        LABELS[f"{_label}/notice/{_n}"] = _label
for _label, _texts in HEADERS.items():
    for _n, _text in enumerate(_texts):
        TEMPLATES[f"{_label}/header/{_n}"] = _text
        LABELS[f"{_label}/header/{_n}"] = _label

for _label, _texts in HEADINGS.items():
    for _n, _text in enumerate(_texts):
        TEMPLATES[f"{_label}/heading/{_n}"] = _text
        LABELS[f"{_label}/heading/{_n}"] = _label
for _label, _name in IDENTIFIERS.items():
    for _n, _form in enumerate(SPDX):
        TEMPLATES[f"{_label}/spdx/{_n}"] = _form.format(_name)
        LABELS[f"{_label}/spdx/{_n}"] = _label

# Phrases and their labels, from the contract.
BASE_PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Spellings that count as equal.
SPELLINGS = {"licence": "license", "licences": "licenses", "licenced": "licensed", "favour": "favor", "organisation": "organization"}
