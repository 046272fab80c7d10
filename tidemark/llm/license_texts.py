"""Fixed values of licence recognition: wording of licence texts and notices as published, and the ordered rules.

A sentence is normalised as :func:`tidemark.llm.license_scan.normal` does it: lower case, words of letters, digits and
inner full stops, one space. One sentence may be known by several wordings.
"""

from __future__ import annotations

SENTENCES: tuple[tuple[str, str], ...] = (
    ("apache2-notice", "licensed under the apache license version 2.0"),
    ("apache2-notice", "licensed under the apache license version 2.0 the license"),
    ("apache2-header", "licensed under the apache license version 2.0 the license you may not use this file except in compliance with the license"),
    ("apache2-header", "licensed under the apache license version 2.0 the license you may not use this work except in compliance with the license"),
    ("apache2-comply", "you may not use this file except in compliance with the license"),
    ("apache2-comply", "you may not use this work except in compliance with the license"),
    ("apache2-obtain", "you may obtain a copy of the license at"),
    ("apache2-obtain", "you may obtain a copy of the license at http www.apache.org licenses license 2.0"),
    ("apache2-obtain", "you may obtain a copy of the license at https www.apache.org licenses license 2.0"),
    ("apache2-as-is", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied"),
    ("apache2-see", "see the license for the specific language governing permissions and limitations under the license"),
    ("mit-notice", "released under the mit license"),
    ("mit-notice", "licensed under the mit license"),
    ("mit-title", "mit license"),
    ("mit-title", "the mit license"),
    ("mit-title", "the mit license mit"),
    ("mit-grant", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions"),
    ("mit-include", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit-as-is", "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement"),
    ("mit-liability", "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software"),
    ("bsd-intro", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd-source", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd-binary", "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"),
    ("bsd-names", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("bsd-as-is", "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed"),
    ("bsd-liability", "in no event shall the copyright holder or contributors be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use data or profits or business interruption however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage"),
    ("isc-grant", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("isc-as-is", "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness"),
    ("isc-liability", "in no event shall the author be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other tortious action arising out of or in connection with the use or performance of this software"),
    ("gpl3-notice", "this work is licensed under the gnu general public license version 3"),
    ("gpl3-notice", "licensed under the gnu general public license version 3"),
    ("gpl2-notice", "licensed under the gnu general public license version 2"),
    ("gpl3-free", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("gpl2-free", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version"),
    ("agpl3-free", "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("lgpl21-free", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2.1 of the license or at your option any later version"),
    ("lgpl3-free", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("gpl-hope", "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose"),
    ("gpl-hope", "this library is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose"),
    ("gpl-details", "see the gnu general public license for more details"),
    ("gpl-details", "see the gnu affero general public license for more details"),
    ("gpl-details", "see the gnu lesser general public license for more details"),
    ("gpl-copy", "you should have received a copy of the gnu general public license along with this program"),
    ("gpl-copy", "you should have received a copy of the gnu affero general public license along with this program"),
    ("gpl-copy", "you should have received a copy of the gnu lesser general public license along with this library"),
    ("gpl-copy", "you should have received a copy of the gnu general public license along with this program if not write to the free software foundation inc. 51 franklin street fifth floor boston ma 02110 1301 usa"),
    ("gpl-copy", "you should have received a copy of the gnu lesser general public license along with this library if not write to the free software foundation inc. 51 franklin street fifth floor boston ma 02110 1301 usa"),
    ("gpl-see", "if not see https www.gnu.org licenses"),
    ("gpl-see", "if not see http www.gnu.org licenses"),
    ("mpl2-notice", "this source code form is subject to the terms of the mozilla public license v. 2.0"),
    ("mpl2-copy", "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla.org mpl 2.0"),
    ("mpl2-copy", "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla.org mpl 2.0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("cc-by-nc-notice", "licensed under cc by nc 4.0"),
    ("cc-by-notice", "licensed under cc by 4.0"),
    ("cc-by-notice", "this work is licensed under a creative commons attribution 4.0 international license"),
    ("cc-by-sa-notice", "this work is licensed under a creative commons attribution sharealike 4.0 international license"),
    ("cc-by-nc-notice", "this work is licensed under a creative commons attribution noncommercial 4.0 international license"),
)

# Ordered: at one place the first that fits is taken, so longer sequences stand before their beginnings.
RULES: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("Apache-2.0", ("apache2-header", "apache2-obtain", "apache2-as-is", "apache2-see")),
    ("Apache-2.0", ("apache2-header", "apache2-obtain")),
    ("Apache-2.0", ("apache2-header",)),
    ("Apache-2.0", ("apache2-notice", "apache2-comply", "apache2-obtain", "apache2-as-is", "apache2-see")),
    ("Apache-2.0", ("apache2-notice", "apache2-comply", "apache2-obtain")),
    ("Apache-2.0", ("apache2-notice",)),
    ("MIT", ("mit-title", "mit-grant", "mit-include", "mit-as-is", "mit-liability")),
    ("MIT", ("mit-notice", "mit-grant", "mit-include", "mit-as-is", "mit-liability")),
    ("MIT", ("mit-grant", "mit-include", "mit-as-is", "mit-liability")),
    ("MIT", ("mit-grant", "mit-include", "mit-as-is")),
    ("MIT", ("mit-notice",)),
    ("BSD-3-Clause", ("bsd-intro", "bsd-source", "bsd-binary", "bsd-names", "bsd-as-is", "bsd-liability")),
    ("BSD-3-Clause", ("bsd-intro", "bsd-source", "bsd-binary", "bsd-names")),
    ("BSD-2-Clause", ("bsd-intro", "bsd-source", "bsd-binary", "bsd-as-is", "bsd-liability")),
    ("BSD-2-Clause", ("bsd-intro", "bsd-source", "bsd-binary")),
    ("ISC", ("isc-grant", "isc-as-is", "isc-liability")),
    ("ISC", ("isc-grant",)),
    ("GPL-3.0-or-later", ("gpl3-free", "gpl-hope", "gpl-details", "gpl-copy", "gpl-see")),
    ("GPL-3.0-or-later", ("gpl3-free", "gpl-hope", "gpl-details")),
    ("GPL-3.0-or-later", ("gpl3-free",)),
    ("GPL-2.0-or-later", ("gpl2-free", "gpl-hope", "gpl-details", "gpl-copy")),
    ("GPL-2.0-or-later", ("gpl2-free", "gpl-hope", "gpl-details")),
    ("GPL-2.0-or-later", ("gpl2-free",)),
    ("AGPL-3.0-or-later", ("agpl3-free", "gpl-hope", "gpl-details", "gpl-copy", "gpl-see")),
    ("AGPL-3.0-or-later", ("agpl3-free", "gpl-hope", "gpl-details")),
    ("AGPL-3.0-or-later", ("agpl3-free",)),
    ("LGPL-2.1-or-later", ("lgpl21-free", "gpl-hope", "gpl-details", "gpl-copy")),
    ("LGPL-2.1-or-later", ("lgpl21-free", "gpl-hope", "gpl-details")),
    ("LGPL-2.1-or-later", ("lgpl21-free",)),
    ("LGPL-3.0-or-later", ("lgpl3-free", "gpl-hope", "gpl-details", "gpl-copy", "gpl-see")),
    ("LGPL-3.0-or-later", ("lgpl3-free", "gpl-hope", "gpl-details")),
    ("LGPL-3.0-or-later", ("lgpl3-free",)),
    ("GPL-3.0", ("gpl3-notice",)),
    ("GPL-2.0", ("gpl2-notice",)),
    ("MPL-2.0", ("mpl2-notice", "mpl2-copy")),
    ("MPL-2.0", ("mpl2-notice",)),
    ("Unlicense", ("unlicense",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-notice",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-notice",)),
    ("CC-BY-4.0", ("cc-by-notice",)),
)
PERMISSIVE = ("Apache-2.0", "MIT", "BSD-3-Clause", "BSD-2-Clause", "ISC", "Unlicense", "CC-BY-4.0")
ANCHORS = "license|permission|redistribut|warrant|without|in no event|software|mpl"
